"""Whitening against exact fractions and a dense eigensolver."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from shelflife.llm import whitening
from shelflife.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def polynomial_by_hand(m):
    """Faddeev and LeVerrier's recursion in fractions, lowest coefficient first."""
    d = len(m)
    out, c = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        c = [[c[i][j] + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c = [[sum(m[i][t] * c[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        out.append(-sum(c[i][i] for i in range(d)) / k)
    return [int(x) for x in reversed(out)]


def semidefinite(rng, d, rank, size):
    x = [[rng.randrange(-size, size + 1) for _ in range(d)] for _ in range(rank)]
    return [[sum(r[i] * r[j] for r in x) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d,rank,size", [(1, 1, 9), (2, 2, 5), (3, 1, 4), (5, 5, 10**6), (8, 3, 50), (9, 20, 10**12), (6, 0, 1)])
def test_characteristic_polynomial(monkeypatch, d, rank, size):
    monkeypatch.setattr(whitening, "_CELLS", 3 * d * d)
    rng = random.Random(d)
    m = semidefinite(rng, d, rank, size)
    assert whitening.characteristic_polynomial(m) == polynomial_by_hand(m)


def test_polynomial_where_pivots_vanish():
    m = [[2, 0, 0, 1], [0, 3, 0, 0], [0, 0, 3, 0], [1, 0, 0, 2]]
    assert whitening.characteristic_polynomial(m) == polynomial_by_hand(m)


def product(roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    return poly


@pytest.mark.parametrize("roots", [[0, 0, 3], [5, 5, 5, 1], [7], [0, 0], [10**9, 10**9 - 1, 2, 1, 0], [4, 2, 2, 1]])
def test_whole_roots_with_multiplicity(roots):
    poly = product(roots)
    for c in range(0, 12):
        assert whitening.roots_above(poly, c) == sum(r > c for r in roots)
    found, bits = whitening.largest_roots(poly, max(sum(roots), 1), 4)
    want = sorted((r for r in roots if r), reverse=True)[:4]
    assert [Fraction(f, 1 << bits) for f in found] == want


def test_irrational_roots():
    poly = product([3, 6, 9, 12])
    poly[0] += 7  # the roots move, but stay real
    found, bits = whitening.largest_roots(poly, 30, 4)
    want = sorted(np.roots(poly[::-1]).real, reverse=True)
    assert [f / 2**bits for f in found] == pytest.approx(want, rel=1e-12)
    for f in found:  # the sign turns between neighbours of the last digit
        around = [sum(a * Fraction(f + s, 1 << bits) ** j for j, a in enumerate(poly)) for s in (-1, 2)]
        assert around[0] * around[1] < 0


def by_hand(rows, scale=256, components=4):
    """Rows by a dense eigensolver; deviations in whole numbers."""
    valid = [
        (i, [min(max(math.floor(scale * float(c)), -(2**63)), 2**63 - 1024) for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    distinct = {tuple(x) for _, x in valid}
    lengths = {len(x): sum(len(y) == len(x) for y in distinct) for x in distinct}
    d = max(lengths, key=lambda k: (lengths[k], k)) if lengths else 0
    fitted = [x for x in distinct if len(x) == d]
    n = len(fitted)
    sums = [sum(c) for c in zip(*fitted, strict=True)]
    if n < 2:
        return {}, n
    y = np.array([[n * a - s for a, s in zip(x, sums, strict=True)] for x in fitted], object)
    values, vectors = np.linalg.eigh((y.T @ y / n).astype(float) / n**2)
    top = [k for k in reversed(range(d)) if values[k] > 1e-9 * values.max()][:components]
    out = {}
    for i, x in valid:
        if len(x) == d:
            own = [n * a - s for a, s in zip(x, sums, strict=True)]
            deviation = sum(a * a for a in own)
            projected = [abs(np.dot(np.array(own, float) / n, vectors[:, k])) / math.sqrt(values[k]) for k in top]
            out.setdefault((i, deviation), []).append((projected, [values[k] / values.sum() for k in top]))
    return out, n


def frame(spark, rows, kind="double"):
    given = [(i, v, 3, "x", 1.5) for i, v in rows]
    return spark.createDataFrame(given, f"vec_id bigint, embedding array<{kind}>, n int, component string, whitened double")


def check(spark, rows, kind="double"):
    vectors = frame(spark, rows, kind)
    model = whitening.fit(vectors)
    found = whitening.by_component(whitening.whiten(vectors, model), model).collect()
    want, n = by_hand(rows)
    got = {}
    for r in sorted(found, key=lambda r: r.component):
        assert r.n == n and 0 <= r.identity_error < 1e-9
        got.setdefault((r.id, r.deviation), []).append((abs(r.whitened), r.explained))
    as_long = {(i, v if v < 2**63 else None): w for (i, v), w in want.items()}
    assert set(got) == set(as_long)
    for key, copies in as_long.items():
        flat = sorted(x for projected, shares in copies for x in zip(projected, shares, strict=True))
        for (a, b), (c, e) in zip(sorted(got[key]), flat, strict=True):
            assert a == pytest.approx(c, rel=1e-6, abs=1e-7) and b == pytest.approx(e, rel=1e-9)
    return found, model


def test_odd_rows(spark):
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1 + k) for k in range(5)]) for i in range(40)]
    rows += [(i, v) for i, v in rows[:9]] + [(100, rows[3][1]), (None, rows[4][1])]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [NAN] * 5), (204, [1.0, INF, 0, 0, 0])]
    rows += [(205, [1.0, 2.0]), (206, [0.0] * 5), (207, [-0.0] * 5), (208, [0.001] * 5), (209, [-0.001] * 5)]
    found, model = check(spark, [(i, v and [None if c is None else float(c) for c in v]) for i, v in rows])
    assert model.dims == 5 and {r.component for r in found} == {1, 2, 3, 4}


def test_whitened_rows_have_unit_covariance(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    vectors = frame(spark, rows)
    model = whitening.fit(vectors)
    got = np.array([r.whitened for r in whitening.whiten(vectors, model).collect()])
    assert np.abs(np.cov(got.T, bias=True) - np.eye(4)).max() < 1e-9 and np.abs(got.mean(axis=0)).max() < 1e-9


def test_few_dimensions_and_little_rank(spark):
    check(spark, [(1, [1.0]), (2, [2.0]), (3, [2.0])])
    check(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)])
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, []), (2, [])]):
        vectors = frame(spark, rows)
        model = whitening.fit(vectors)
        assert whitening.by_component(whitening.whiten(vectors, model), model).count() == 0


def test_equal_eigenvalues(spark):
    rows = [(i, [float(v) for v in s * np.eye(3)[k]]) for i, (s, k) in enumerate((s, k) for s in (-1, 1) for k in range(3))]
    vectors = frame(spark, rows)
    model = whitening.fit(vectors)
    assert np.abs(np.array(model.vectors) @ np.array(model.vectors).T - np.eye(3)).max() < 1e-12
    assert model.explained == pytest.approx([1 / 3] * 3) and model.identity_error < 1e-12


def test_large_entries(spark):
    rng = random.Random(5)
    for size in (3e4, 1e8, 1e15, 1e300):
        rows = [(i, [rng.uniform(-size, size) for _ in range(3)]) for i in range(12)]
        check(spark, rows)
    packed = [a.to_pylist() for a in whitening.pack(np.array([[1, -2], [40_000, 0], [1 << 40, 3], [-(1 << 15), 5]]))]
    assert sorted(len(v) for a in packed for v in a) == [5, 5, 9, 17]


def test_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.integers(-500, 500, size=(700, 4))
    monkeypatch.setattr(whitening, "_EXACT", 1 << 22)
    assert (whitening.gram(x) == x.astype(object).T @ x.astype(object)).all()
    big = x.astype(object) * 10**12
    assert (whitening.gram(big.astype(np.int64)) == big.T @ big).all()


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = QUERIES["op11_whitening"](spark, sf_dir).collect()
    want, n = by_hand([(r.vec_id, r.embedding) for r in rows])
    assert len(found) == 4 * len(rows)
    for r in found:
        (projected, shares), = want[r.vec_id, r.deviation]
        assert abs(r.whitened) == pytest.approx(projected[r.component - 1], abs=1e-8)
        assert r.explained == pytest.approx(shares[r.component - 1]) and r.n == n and r.identity_error < 1e-12
