"""Targets, taken words and places against the rules applied one step at a time."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelflife.llm import mixing

DOCS = [
    (1, "a b c", "x"), (2, None, "x"), (3, "", "y"), (4, "one\x0btwo still two", None), (5, "w " * 5000, "big"),
    (6, "q", "tiny"), (6, "q", "tiny"), (None, "no id", "x"), (None, None, None), (7, "ß", "Z"), (8, "x y", "é"),
    *[(100 + i, "word " * (i % 9), "big") for i in range(60)],
]


def words(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return len([w for w in (text or "").split(" ") if w])


def shares(docs, weights=(1, 2, 3), repeat=3):
    """Source sizes and targets, sharing the excess again until none is above."""
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + words(t)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        unit = (total - sum(full.values())) / max(sum(weight[s] for s in rest), 1)
        above = [s for s in rest if unit * weight[s] > repeat * sizes[s]]
        if not above:
            return sizes, weight, {**full, **{s: unit * weight[s] for s in rest}}
        full.update({s: repeat * sizes[s] for s in above})


def frame(spark, docs=DOCS):
    rows = [(i, t, s, 0.5, "k") for i, t, s in docs]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, target double, key string")


@pytest.mark.parametrize("bucket_rows", [16_384, 4])
def test_odd_documents(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    rows = mixing.mixture(frame(spark)).collect()
    sizes, _, targets = shares(DOCS)
    assert len(rows) == len(DOCS)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size and (r.place is None) == (r.taken == 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: int(t + 0.5) for s, t in targets.items()}
    # In the order of the hash, whole documents first and one in part.
    big = sorted(
        (r for r in rows if r.source == "big"),
        key=lambda r: (hashlib.md5(f"{r.id}:mix".encode()).hexdigest(), r.id),
    )
    passes = int(targets["big"] + 0.5) // sizes["big"]
    extra = [r.taken - passes * r.size for r in big if r.size]
    whole = [e == r.size for e, r in zip(extra, [r for r in big if r.size], strict=True)]
    assert whole == sorted(whole, reverse=True) and sum(0 < e for e in extra) <= sum(whole) + 1
    again = mixing.mixture(frame(spark)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_targets_of_random_sources(spark):
    rng = random.Random(6)
    for _ in range(3):
        docs = [(i, "w " * rng.choice([0, 1, 5, 400]), f"s{rng.randrange(8)}") for i in range(40)]
        _, weight, targets = shares(docs)
        sizes = {s: sum(words(t) for _, t, x in docs if x == s) for s in weight}
        given = spark.createDataFrame(
            [(s, sizes[s], w) for s, w in weight.items()], "source string, source_size bigint, weight int"
        )
        got = {r.source: r.target for r in mixing.targets(given).collect()}
        assert got == pytest.approx(targets)


@pytest.mark.parametrize(
    "knots",
    [[(0, 1.5), (1, 0.5)], [(0, 1), (1, 1)], [(0, 0), (1, 2)], [(0, 2), (0.25, 0.5), (0.5, 0.5), (1, 3)]],
)
def test_places_invert_the_integral(spark, knots):
    shares_ = [i / 40 for i in range(41)]
    rows = spark.createDataFrame([(s,) for s in shares_], "s double")
    places = [r[0] for r in rows.select(mixing.place(F.col("s"), knots)).collect()]

    def integral(t):
        total = 0.0
        for (a, x), (b, y) in zip(knots, knots[1:], strict=False):
            if t > a:
                end = min(t, b)
                total += (end - a) * (x + (x + (y - x) * (end - a) / (b - a))) / 2
        return total

    for share, place in zip(shares_, places, strict=True):
        assert integral(place) / integral(1) == pytest.approx(share, abs=1e-9)


def test_every_copy_has_its_place(spark):
    mixed = mixing.mixture(frame(spark))
    rows, copies = mixed.collect(), mixing.training_order(mixed).collect()
    sizes, weight, targets = shares(DOCS)
    got = sorted((str(r.source), r.id or -1, r.copy, r.words, r.place) for r in copies)
    want = []
    for s, size in sizes.items():
        # Each source's words one document after another, pass after pass, up to its goal.
        own = sorted(
            (hashlib.md5(f"{'' if i is None else f'{i}:'}mix".encode()).hexdigest(), i is not None, i or -1, words(t))
            for i, t, x in DOCS if x == s
        )
        goal, begin = int(targets[s] + 0.5), 0
        for copy in range(3):
            for _, _, i, n in own:
                if n and begin < goal:
                    (t0, r0), (t1, r1) = mixing.RAMPS[weight[s]]
                    lo, hi = 0.0, 1.0
                    for _ in range(60):
                        mid = (lo + hi) / 2
                        asked = mid * (r0 + (r0 + (r1 - r0) * mid)) / (r0 + r1)
                        lo, hi = (mid, hi) if asked < begin / goal else (lo, mid)
                    want.append((str(s), i, copy, min(n, goal - begin), pytest.approx(lo, abs=1e-9)))
                begin += n
    assert len(got) == len(want) > len([r for r in rows if r.taken])
    assert got == sorted(want, key=lambda r: (*r[:4], r[4].expected))
    assert [r.place for r in copies] == sorted(r.place for r in copies)
    assert all(len(r.places) == -(-r.taken // r.size) if r.size else r.places == [] for r in rows)
    assert max(r.place for r in copies if r.source == "tiny") > 2 / 3


def test_training_order_and_empty_table(spark):
    ordered = mixing.training_order(mixing.mixture(frame(spark))).collect()
    assert [r.place for r in ordered] == sorted(r.place for r in ordered)
    assert mixing.mixture(frame(spark).limit(0)).count() == 0
