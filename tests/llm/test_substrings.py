"""Suffix arrays and removals against brute force."""

import hashlib
import random

import numpy as np
import pytest

from shelflife.llm import substrings
from shelflife.llm.queries import QUERIES
from shelflife.llm.suffix import common_prefixes, suffix_array


def pieces_of(pieces):
    sizes = np.array([len(p) for p in pieces], np.int64)
    stops = np.cumsum(sizes)
    return np.frombuffer(b"".join(pieces), np.uint8), stops - sizes, stops


@pytest.mark.parametrize("letters", [b"ab", b"abcdefgh", b"\x00\xff"])
def test_suffix_array_and_common_prefixes(letters):
    rng = random.Random(8)
    for _ in range(30):
        pieces = [bytes(rng.choice(letters) for _ in range(rng.randrange(0, 30))) for _ in range(rng.randrange(1, 12))]
        pieces += rng.sample(pieces, len(pieces) // 2)
        text, starts, stops = pieces_of(pieces)
        suffixes = []
        for k, (p, s) in enumerate(zip(pieces, starts, strict=True)):
            suffixes += [(p[i:], k, int(s) + i) for i in range(len(p))]
        suffixes.sort()
        order = suffix_array(text, np.repeat(stops, stops - starts))
        assert order.tolist() == [s[2] for s in suffixes]
        want = [0] if suffixes else []
        for (a, _, _), (b, _, _) in zip(suffixes, suffixes[1:], strict=False):
            want.append(next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b))))
        assert common_prefixes(text, starts, stops, order).tolist() == want
        long = [n if len(s[0]) >= 9 else 0 for n, s in zip(want, suffixes, strict=True)]
        assert common_prefixes(text, starts, stops, order, least=9).tolist() == long


def by_hand(docs):
    n = substrings.LENGTH
    big = 1 << 62
    first = {}
    for i, t in docs:
        data = (t or "").encode()
        for p in range(len(data) - n + 1):
            w = data[p : p + n]
            first[w] = min(first.get(w, big + 1), big if i is None else i)
    out = []
    for i, t in docs:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - n + 1):
            if first[data[p : p + n]] < (big if i is None else i):
                gone[p : p + n] = b"\1" * n
        spans = sum(1 for p in range(len(data)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(found):
    return sorted((tuple(r) for r in substrings.digest(found).collect()), key=str)


def odd_docs():
    rng = random.Random(9)
    line = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passage, other = line(130), line(70)
    docs = [(i, line(200) + passage + line(rng.randrange(90))) for i in range(5, 25)]
    docs += [(100 + i, other * 3) for i in range(4)] + [(200, "x" * 5000), (201, "x" * 49), (202, "x" * 50)]
    docs += [(300, None), (301, ""), (302, passage[:49]), (303, passage[10:70]), (303, passage), (303, passage)]
    docs += [(None, passage + line(60)), (None, passage), (-5, line(30) + passage + other), (400, "ab" * 400)]
    docs += [(401, "ab" * 300 + passage), (402, "\x00" * 300), (403, "\x00" * 120 + "\x01"), (404, docs[0][1])]
    docs += [(500 + i, line(100)[:40] + passage[20:90] + str(i)) for i in range(12)]
    return docs


@pytest.mark.parametrize(("shard", "positions"), [(10**7, 1 << 20), (3000, 1 << 20), (1500, 500)])
def test_odd_documents(spark, monkeypatch, shard, positions):
    monkeypatch.setattr(substrings, "POSITIONS", positions)
    docs = odd_docs()
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, shard string")
    found = substrings.without_repeats(frame, shard_bytes=shard)
    assert got(found) == by_hand(docs)
    for r in found.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_arrays_are_merged_by_search(monkeypatch):
    """The same answer whether a bucket has one suffix array or many."""
    rng = random.Random(10)
    pieces = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(50, 84))) for _ in range(40)]
    pieces = [rng.choice(pieces[:10])[:50] + p[: rng.randrange(0, 34)] for p in pieces]
    text, starts, stops = pieces_of(pieces)
    ids = np.array([rng.randrange(1000) for _ in pieces], np.int64)
    whole = np.concatenate([np.arange(a, b - substrings.LENGTH + 1) for a, b in zip(starts, stops, strict=True)])
    one = substrings.least_ids(text, starts, stops, ids)[whole]
    monkeypatch.setattr(substrings, "POSITIONS", 100)
    assert substrings.least_ids(text, starts, stops, ids)[whole].tolist() == one.tolist()


def test_empty_table(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    assert substrings.without_repeats(docs.limit(0)).count() == 0


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")[["doc_id", "text"]].collect()]
    assert sorted((tuple(r) for r in QUERIES["op3_suffix_array"](spark, sf_dir).collect()), key=str) == by_hand(docs)
