"""Winnowing against a brute-force reading of the rule."""

import hashlib
import re

import pytest

from shelflife.llm import decontaminate
from shelflife.llm.queries import QUERIES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def by_hand(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if items_here := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= items_here
        names = ",".join(sorted(map(str, found)))
        out.append(
            (doc, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
             bool(hit) and 20 * len(hit) >= len(w))
        )
    return sorted(out, key=str)


A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
DOCS = [
    (1, A), (2, None), (3, ""), (4, "... --- !!"), (5, "x " * 700 + A + " y" * 700),
    (6, "ONE Two,three four five six seven eight nine ten eleven twelve"),  # 12 words only
    (7, "alpha beta"), (8, "alpha beta gamma alpha beta"), (9, "été über " + A.upper()),
    (9, "a repeated id " + A), (9, "a repeated id " + A), (None, A), (10, "a " * 40),
    (11, "Été alpha"), (12, "été alpha"), (13, A + " " + A),
]
ITEMS = [
    (1, A), (2, A), (3, "Alpha, beta"), (4, None), (5, "?!"), (6, "a " * 20),
    (7, "zero " + A.replace("fifteen", "sixteen")), (8, "été alpha"), (100, "gamma"),
]


def frames(spark, docs, items):
    extra = [(i, t, "x", 1) for i, t in docs]
    return (
        spark.createDataFrame(extra, "doc_id bigint, text string, spans string, n_words int"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )


def digests(found):
    return sorted((tuple(r) for r in decontaminate.digest(found).collect()), key=str)


@pytest.mark.parametrize("block", [10**9, 60])
def test_edge_rows(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, items = frames(spark, DOCS, ITEMS)
    assert digests(decontaminate.contamination(docs, items)) == by_hand(DOCS, ITEMS)


def test_items_without_id_hit_and_pairs_in_steps(spark, monkeypatch):
    found = []
    for pairs in (decontaminate.PAIRS, 3):
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        found.append([])
        for text in ("x " * 30 + A, "alpha beta"):
            data, bounds = decontaminate.np.frombuffer(text.encode(), "u1"), decontaminate.np.array([0, len(text)])
            block = decontaminate.Block([(i, f"{A} {i}") for i in range(9)] + [(None, "alpha beta")], 13, 7)
            hit, where = decontaminate.hits(block, *decontaminate.word_hashes(data, bounds))
            found[-1].append((hit.tolist(), where.tolist()))
    assert found[0] == found[1] and sum(found[0][0][0]) == 15 and len(found[0][0][1]) == 9
    monkeypatch.undo()
    docs, items = frames(spark, [(1, A), (2, "alpha beta"), (3, "gamma")], [(None, A), (None, "Beta"), (7, "gamma")])
    got = {r[0]: (r[2], r[3], r[5]) for r in digests(decontaminate.contamination(docs, items))}
    assert got == {1: (15, 0, True), 2: (1, 0, True), 3: (1, 1, True)}


def test_empty_tables(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert digests(decontaminate.contamination(docs.limit(0), items)) == []
    clean = decontaminate.contamination(docs, items.limit(0))
    assert clean.where("contaminated or n_hit > 0").count() == 0
    assert decontaminate.decontaminated(docs, items).columns == docs.columns
    assert decontaminate.decontaminated(docs, items.limit(0)).count() == len(DOCS)


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")[["doc_id", "text"]].collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = QUERIES["op1_decontamination"](spark, sf_dir)
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_hand(docs, items)


def test_repeated_word_costs_no_product():
    """16 KB of one word against 4 KB of it, and a sentence that thousands of items share."""
    import time

    import numpy as np

    def hashed(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return decontaminate.word_hashes(data, np.array([0, len(data)], np.int64))

    block = decontaminate.Block([(1, "a " * 2_048)], 13, 7)
    words, firsts = hashed("a " * 8_192)
    begin = time.perf_counter()
    hit, pairs = decontaminate.hits(block, words, firsts)
    assert time.perf_counter() - begin < 0.1
    assert hit.all() and pairs.tolist() == [[0, 0]]
    items = [(i, f"{A} then number{i} follows") for i in range(20_000)]
    block = decontaminate.Block(items, 13, 7)
    words, firsts = hashed(f"{A} . " * 200)
    begin = time.perf_counter()
    hit, pairs = decontaminate.hits(block, words, firsts)
    assert time.perf_counter() - begin < 1
    assert hit.all() and len(pairs) == 20_000


def test_texts_go_to_python_once_and_in_small_batches(spark, monkeypatch):
    docs, items = frames(spark, DOCS, ITEMS)
    kind, sent = type(docs), []
    real = kind.mapInArrow

    def noted(rows, *args, **options):
        sent.append(rows.columns)
        return real(rows, *args, **options)

    monkeypatch.setattr(kind, "mapInArrow", noted)
    got = digests(decontaminate.contamination(docs, items))
    assert sent == [["doc", "n_words", "spans", "items"]] and got == by_hand(DOCS, ITEMS)
    # By another spelling the text is a column of its own, and the result is the same.
    assert digests(decontaminate.contamination(docs, items, text_col="TEXT")) == got
    assert sent[1] == ["doc", "text", "n_words", "spans", "items"]
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 8 << 20


def test_results_do_not_depend_on_batches(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "64b")
    try:
        assert digests(decontaminate.contamination(docs, items)) == by_hand(DOCS, ITEMS)
        assert spark.conf.get(key) == "64b"
        assert decontaminate.decontaminated(docs, items).columns == docs.columns
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
