"""Fingerprints and components against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from shelflife.llm import simhash
from shelflife.llm.queries import QUERIES


def print_of(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def by_hand(docs):
    prints = {i: print_of(t) for i, t in docs}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(sorted(prints), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return sorted((i, f"{prints[i]:016x}", find(i)) for i in prints)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


DOCS = [
    (1, "one two three four"), (2, "ONE two\tthree\nfour"), (3, None), (4, ""), (5, " \x0b\x0c "),
    (6, "one"), (7, "one two"), (8, "a " * 400), (9, "été Über " * 500), (10, "Été Über " * 500),
    (11, " ".join(map(str, range(3000)))), (12, " ".join(map(str, range(2999))) + " x"),
]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in DOCS], "doc_id bigint, text string, fp int")
    got = simhash.digest(simhash.near_groups(docs))
    assert rows(got) == by_hand(DOCS)
    kept = simhash.near_deduped(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in by_hand(DOCS)}
    assert simhash.near_groups(docs.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "q r s")], "doc_id bigint, text string"
    )
    got = {tuple(r) for r in simhash.digest(simhash.near_groups(docs))["doc_id", "component_id"].collect()}
    assert got == {(1, 1), (None, 1), (None, None)}


@pytest.mark.parametrize("long_list", [1 << 16, 100, 8])
def test_crowded_fingerprints(spark, long_list, tmp_path):
    """Many fingerprints near one another, through every kind of list."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = set(centres)
    for c in centres:
        low = 32 * rng.randrange(2)
        for _ in range(150):
            x = c
            for b in rng.sample(range(low, low + 32), rng.randrange(1, 7)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    signed = [(int(np.uint64(x).astype(np.int64)),) for x in prints]
    nodes = spark.createDataFrame(signed, "fp bigint")
    found = simhash.components(
        simhash.links(nodes, f"{tmp_path}/l", long_list), f"{tmp_path}/c"
    ).collect()
    root = {x: x for x in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 2:
            root[find(a)] = find(b)
    groups = {}
    for x in prints:
        groups.setdefault(find(x), set()).add(int(np.uint64(x).astype(np.int64)))
    want = {frozenset(g) for g in groups.values() if len(g) > 1}
    got = {}
    for r in found:
        got.setdefault(r.root, set()).add(r.node)
    assert {frozenset(g) for g in got.values()} == want


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")[["doc_id", "text"]]
    assert rows(QUERIES["op2_simhash"](spark, sf_dir)) == by_hand([tuple(r) for r in docs.collect()])
