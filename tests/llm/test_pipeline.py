"""The pipeline against the operators' rules applied by hand, and odd inputs."""

import hashlib
import re

import corpus_pipeline
import test_decontaminate
import test_near
import test_simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def mixed_by_hand(docs):
    """doc_id -> (size, taken) by the rule of the targets, one round of sharing at a time."""
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t))) for i, t, s in docs]
    sizes = {}
    for _, s, n in sized:
        sizes[s] = sizes.get(s, 0) + n
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes))}
    total, targets = sum(sizes.values()), {}
    while True:
        rest = total - sum(targets.values())
        open_ = [s for s in sizes if s not in targets]
        share = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            targets.update(share)
            break
        targets.update({s: 3 * sizes[s] for s in over})
    out = {}
    for s in sizes:
        goal = int(targets[s] + 0.5)
        passes, part = divmod(goal, sizes[s])
        own = sorted((hashlib.md5(f"{i}:mix".encode()).hexdigest(), i, n) for i, x, n in sized if x == s)
        for _, i, n in own:
            out[i] = (n, passes * n + min(max(part, 0), n))
            part -= n
    return out


def near_by_hand(texts):
    """The smallest id of each group: linked fingerprints, or a five-word Jaccard of 0.8 or more."""
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def link(a, b):
        a, b = sorted((find(a), find(b)))
        root[b] = a

    for i, _, first in test_simhash.by_hand(list(texts.items())):
        link(i, first)
    sets = {i: test_near.shingles(t) for i, t in texts.items()}
    for a in sets:
        for b in sets:
            few, many = sorted((len(sets[a]), len(sets[b])))
            if a < b and few >= 0.8 * many and test_near.jaccard(sets[a], sets[b]) >= 0.8:
                link(a, b)
    return {find(i) for i in texts}


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {i for i, r in docs.items() if r.text and re.search(r"[^\W\d_]", r.text)}
    last = {}
    for i in sorted(kept):
        last[docs[i].text] = i
    kept = set(last.values())
    kept = near_by_hand({i: docs[i].text for i in kept})
    found = test_decontaminate.by_hand([(i, docs[i].text) for i in kept], items)
    kept = {r[0] for r in found if not r[5]}
    want = mixed_by_hand([(i, docs[i].text, docs[i].source) for i in kept])
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: (r.size, r.taken) for r in rows} == {i: v for i, v in want.items() if v[1]}
    places = [r.place for r in rows]
    assert len(places) == len(rows) and 0 <= min(places) and max(places) <= 1


def odd(spark):
    rows = [
        (1, "the same text here", "en", "a", 1), (2, "the same text here", None, None, None),
        (3, None, "en", "a", 0), (4, "", "en", None, 0), (5, "12 34 !!", "en", "b", 8),
        (6, "ein anderer text", "de", "b", 5), (6, "ein anderer text", "de", "b", 5),
        (7, "word " * 50_000, "en", "a", 250_000), (None, "no id at all", None, None, None),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stages_keep_the_columns(spark):
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == COLUMNS, name
    left = sorted((r.doc_id or 0, r.text) for r in docs.collect())
    assert [i for i, _ in left] == [0, 2, 6, 7]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 4


def test_empty_tables(spark):
    docs = odd(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0, name
