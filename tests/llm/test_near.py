"""Near copies by word shingles against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa

from shelflife.llm import near
from shelflife.llm.shared import text_parts
from shelflife.operators.joins import some_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, size=5):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def jaccard(a, b):
    return len(a & b) / max(len(a | b), 1)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, id int, node string")


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return words


def groups(found):
    return {r.id: r.component_id for r in found.collect()}


def test_planted_copies_and_strangers(spark):
    rng = random.Random(11)
    rows, want, n = [], {}, 0
    for group in range(60):
        base = [f"w{rng.randrange(5_000)}" for _ in range(rng.randrange(60, 400))]
        head = n
        for copy in range(rng.choice([1, 2, 5])):
            words = base if copy == 0 else edited(rng, base, max(1, len(base) // 80))
            rows.append((n, " ".join(words)))
            want[n] = head
            n += 1
    rng.shuffle(rows)
    sets = {i: shingles(t) for i, t in rows}
    pairs = [(i, want[i]) for i in want if i != want[i] and jaccard(sets[i], sets[want[i]]) >= 0.8]
    got = groups(near.near_groups(frame(spark, rows)))
    assert len(pairs) > 50 and all(got[a] == got[b] for a, b in pairs)
    assert all(want[i] == want[got[i]] for i in got)


def test_one_list_with_most_rows(spark):
    """Thousands of near copies of one text, over many partitions: one stays, and strangers do."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(9_000)}" for _ in range(150)]
    rows = [(i, " ".join(edited(rng, base, 1))) for i in range(3_000)]
    rows += [(10_000 + i, " ".join(f"w{rng.randrange(9_000)}" for _ in range(150))) for i in range(300)]
    docs = frame(spark, rows).repartition(12)
    left = near.near_deduped(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [0, *range(10_000, 10_300)]


def test_edge_rows(spark):
    words = " ".join(f"w{i}" for i in range(100))
    rows = [
        (1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "ONE  two"), (6, "one two three four five"),
        (7, words), (8, words.upper().replace(" ", "\n") + " more"), (7, words + " and more"), (None, words + " last"),
        (9, "word " * 60_000), (10, "word " * 50_000), (11, "x" * 500_000),
    ]
    got = groups(near.near_groups(frame(spark, rows)))
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, None: 7, 9: 9, 10: 9, 11: 11}
    assert sorted(r.doc_id for r in near.near_deduped(frame(spark, rows)).collect()) == [1, 4, 6, 7, 9, 11]
    assert near.near_deduped(frame(spark, rows).limit(0)).count() == 0


def test_recall_against_all_pairs(spark):
    """Queries: ids divisible by 100 and edited copies of them, against every document."""
    rng = random.Random(1)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    top = max(i for i, _ in docs)
    planted = []
    for i, text in docs:
        words = WORDS.findall(text or "")
        if len(words) >= 60:
            planted.append((top + 1 + i, " ".join(edited(rng, words, max(1, len(words) // 70)))))
    docs += planted
    sets = {i: shingles(t) for i, t in docs}
    queries = [i for i in sets if i % 100 == 0 or (i > top and (i - top - 1) % 10 == 0)]
    pairs = [(a, b) for a in queries for b in sets if a != b and sets[a] and jaccard(sets[a], sets[b]) >= 0.8]
    got = groups(near.near_groups(frame(spark, docs)))
    met = sum(got[a] == got[b] for a, b in pairs)
    print(f"{met} of {len(pairs)} pairs at 0.8 or more met")
    assert len(pairs) >= 50 and met >= 0.97 * len(pairs)


def meeting_pairs(texts):
    """All pairs at 0.8 that agree on a list and share enough bytes, by brute force."""
    keys, marks = [], []
    for _, _, data, bounds in text_parts(pa.array(texts)):
        k, m = near.signatures(*near.shingles(data, bounds, near.SHINGLE))
        keys.append(k)
        marks.append(m)
    keys, marks = np.concatenate(keys), np.concatenate(marks)
    sets = [shingles(t) for t in texts]
    for i in range(len(texts)):
        met = (keys[i + 1 :] == keys[i]).any(axis=1) & ((marks[i + 1 :] == marks[i]).sum(axis=1) >= near.SHARED)
        yield from ((i, i + 1 + j) for j in np.flatnonzero(met).tolist() if jaccard(sets[i], sets[i + 1 + j]) >= 0.8)


def test_every_pair_that_meets_in_a_list_is_linked(spark):
    """Texts about as similar to their leaders as to each other; no weak leader may be lost for good."""
    rng = random.Random(3)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(9_000)}" for _ in range(120)]
        texts += [" ".join(edited(rng, base, rng.randrange(1, 4))) for _ in range(40)]
    pairs = list(meeting_pairs(texts))
    assert len(pairs) > 500
    for weak in (near.WEAK, 2):
        got = groups(near.near_groups(frame(spark, list(enumerate(texts))).repartition(6), weak=weak))
        assert [p for p in pairs if got[p[0]] != got[p[1]]] == []


def test_bitmap_marks_all_wanted(spark):
    rows = spark.range(-2_000, 2_000).selectExpr("xxhash64(id) as node", "id")
    wanted = rows.where("id % 7 = 0").select("node")
    got = {r.id: r._maybe for r in some_of(rows, "node", wanted).collect()}
    assert len(got) == 4_000 and all(got[i] for i in got if i % 7 == 0)
    assert sum(got.values()) < 600
    assert not any(r._maybe for r in some_of(rows, "node", wanted.limit(0)).collect())
