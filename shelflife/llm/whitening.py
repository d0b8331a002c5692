"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Vectors become integers, ``floor(scale * entry)``.  The fit list holds each distinct
integer vector once; its scatter ``n * sum(x x') - sum(x) sum(x)'``, which is the
covariance times ``n**2``, is summed in integers, so it is exact.  On the driver, which
sees that matrix only:

1. the matrix is reduced to Hessenberg form modulo many primes below 2**31, all of them
   side by side, each giving its characteristic polynomial modulo the prime, and Chinese
   remaindering gives the integer coefficients (Maclaurin's inequality bounds them);
2. all roots are real, so the sign changes of the polynomial shifted by c count the roots
   above c exactly: the largest roots are isolated by halving, then narrowed to some
   hundred digits;
3. a component spans the null space of the matrix less its root, found by inverse
   iteration in decimals of that many digits.

The scatter and the distinct vectors are Spark jobs: vectors are shuffled once, packed to
two bytes an entry where that holds them, copies are dropped before the shuffle, and each
task sends one sum per pair of dimensions.  Driver and every task hold O(d**2) numbers; the
decomposition takes O(d**3) steps for each prime, some seconds at 64 dimensions.

Defined cases: rows whose vector is null, or holds null or non-finite entries, are dropped,
as are those that have not the length that most distinct vectors have (the longer one on a
tie); entries beyond a 64-bit integer count as the nearest one; repeated rows are each
reported but fitted once; components without variance are not reported, so one distinct
vector, empty vectors and an empty table give an empty result; equal eigenvalues get some
orthonormal basis of their space; a null id is reported; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.shared import run_folder, ship, stage

SCALE = 256
COMPONENTS = 4
BLOCK = 1 << 20  # entries handled at once
_EXACT = 1 << 53  # integers below are exact as doubles
_LIMB = 40
_CELLS = 1 << 22  # of matrices modulo primes, handled at once


# ---------------------------------------------------------------- integer vectors


def integers(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their integer vectors) of the valid vectors of a list column, by length and block."""
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes nan
    sizes = np.diff(offsets)
    valid = np.array(column.is_valid()) & (sizes > 0)
    bad = np.zeros(len(values) + 1, np.int64)
    np.cumsum(~np.isfinite(values), out=bad[1:])
    valid &= bad[offsets[1:]] == bad[offsets[:-1]]
    for size in np.unique(sizes[valid]):
        rows = np.flatnonzero(valid & (sizes == size))
        step = max(1, BLOCK // int(size))
        for lo in range(0, len(rows), step):
            some = rows[lo : lo + step]
            with np.errstate(over="ignore"):
                x = np.floor(values[offsets[some][:, None] + np.arange(size)] * scale)
            yield some, np.clip(x, -(2.0**63), 2.0**63 - 1024).astype(np.int64)


def pack(vectors: np.ndarray) -> Iterator[pa.Array]:
    """Each vector as bytes: the width of its entries, then the entries; equal for equal vectors."""
    high, low = vectors.max(axis=1), vectors.min(axis=1)
    width = np.full(len(vectors), 8)
    width[(high < 1 << 31) & (low >= -(1 << 31))] = 4
    width[(high < 1 << 15) & (low >= -(1 << 15))] = 2
    for w in np.unique(width):
        flat = np.ascontiguousarray(vectors[width == w].astype(f"<i{w}")).view(np.uint8)
        flat = np.concatenate([np.full((len(flat), 1), w, np.uint8), flat], axis=1)
        bounds = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
        yield pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(bounds), pa.py_buffer(flat.tobytes())])


def unpack(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    """The vectors of packed bytes, by the width of their entries and by block."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    starts = offsets[:-1].astype(np.int64)
    width = data[starts]
    step = max(1, BLOCK // dims)
    for w in np.unique(width):
        own = starts[width == w]
        for lo in range(0, len(own), step):
            at = own[lo : lo + step, None] + 1 + np.arange(int(w) * dims)
            yield data[at].view(f"<i{w}").astype(np.int64)


def _keys(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, x in integers(batch.column(0), scale):
            for packed in pack(x):
                yield pa.RecordBatch.from_arrays([packed], ["key"])


# ---------------------------------------------------------------- exact sums


def gram(x: np.ndarray) -> np.ndarray:
    """``x.T @ x`` as exact integers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    most = np.abs(x.astype(np.float64)).max(axis=1, initial=0)
    small = x[most < 1 << 24].astype(np.float64)
    if len(small):
        top = max(int(most[most < 1 << 24].max()), 1)
        step = max(1, (_EXACT - 1) // (top * top))
        for lo in range(0, len(small), step):
            part = small[lo : lo + step]
            total += (part.T @ part).astype(np.int64).astype(object)
    large = x[most >= 1 << 24].astype(object)
    return total + large.T @ large if len(large) else total


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        if part := value & ((1 << _LIMB) - 1):
            yield place, sign * part
        value >>= _LIMB
        place += 1


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Count, sums and products of a task's vectors, cell by cell in limbs of 40 bits."""
    n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
    for batch in batches:
        for x in unpack(batch.column(0), dims):
            n += len(x)
            sums += x.astype(object).sum(axis=0) if np.abs(x).max() >= 1 << 31 else x.sum(axis=0).astype(object)
            products += gram(x)
    if n:
        cells = [n, *sums.tolist(), *products[np.triu_indices(dims)].tolist()]
        rows = [(cell, place, part) for cell, value in enumerate(cells) for place, part in _limbs(int(value))]
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cell", "place", "part"])


# ---------------------------------------------------------------- characteristic polynomial


def primes_below(top: int) -> Iterator[int]:
    """Primes in falling order."""
    root = math.isqrt(top) + 1
    sieve = np.ones(root + 1, bool)
    sieve[:2] = False
    for i in range(2, math.isqrt(root) + 1):
        if sieve[i]:
            sieve[i * i :: i] = False
    small = np.flatnonzero(sieve)
    for candidate in range(top - 1, 1, -1):
        divisors = small[small * small <= candidate]
        if (candidate % divisors).all():
            yield candidate


def hessenberg_mod(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Matrices similar to ``a[i]`` modulo ``p[i]``, zero below the subdiagonal."""
    a, d, p1, p2 = a.copy(), a.shape[1], p[:, None], p[:, None, None]
    every = np.arange(len(p))
    for k in range(d - 2):
        pivot = k + 1 + np.argmax(a[:, k + 1 :, k] != 0, axis=1)
        rows = a[every, pivot].copy()
        a[every, pivot] = a[:, k + 1]
        a[:, k + 1] = rows
        columns = a[every, :, pivot].copy()
        a[every, :, pivot] = a[:, :, k + 1]
        a[:, :, k + 1] = columns
        inverse = [pow(int(v), -1, int(q)) if v else 0 for v, q in zip(a[:, k + 1, k], p, strict=True)]
        factor = a[:, k + 2 :, k] * np.array(inverse, np.int64)[:, None] % p1
        a[:, k + 2 :] = (a[:, k + 2 :] - factor[:, :, None] * a[:, k + 1 : k + 2] % p2) % p2
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2 :] * factor[:, None] % p2).sum(axis=2)) % p1
    return a


def polynomial_mod(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients, lowest first, of ``det(x - h[i])`` modulo ``p[i]`` for Hessenberg matrices."""
    count, d, p1 = len(p), h.shape[1], p[:, None]
    made = np.zeros((d + 1, count, d + 1), np.int64)
    made[0, :, 0] = 1
    for m in range(1, d + 1):
        new = np.zeros((count, d + 1), np.int64)
        new[:, 1:] = made[m - 1][:, :-1]
        new -= h[:, m - 1, m - 1][:, None] * made[m - 1] % p1
        below = np.ones(count, np.int64)
        for i in range(1, m):
            below = below * h[:, m - i, m - i - 1] % p
            new -= (below * h[:, m - 1 - i, m - 1] % p)[:, None] * made[m - 1 - i] % p1
        made[m] = new % p1
    return made[d]


def characteristic_polynomial(matrix: list[list[int]]) -> list[int]:
    """Coefficients, lowest first, of ``det(x - matrix)`` for a positive semidefinite integer matrix."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d)
    bound = 2 * max(math.comb(d, k) * mean**k for k in range(d + 1)) + 1
    primes, product = [], 1
    for p in primes_below(1 << 31):
        if product > bound:
            break
        primes.append(p)
        product *= p
    flat = [v for row in matrix for v in row]
    totals, step = [0] * (d + 1), max(1, _CELLS // (d * d))
    for lo in range(0, len(primes), step):
        some = primes[lo : lo + step]
        p = np.array(some, np.int64)
        residues = np.array([[v % q for v in flat] for q in some], np.int64).reshape(len(some), d, d)
        found = polynomial_mod(hessenberg_mod(residues, p), p)
        for q, row in zip(some, found.tolist(), strict=True):
            rest = product // q
            unit = rest * pow(rest, -1, q)
            for k, residue in enumerate(row):
                totals[k] += residue * unit
    signed = (t % product for t in totals)
    return [t - product if 2 * t > product else t for t in signed]


# ---------------------------------------------------------------- roots


def roots_above(poly: list[int], c: int) -> int:
    """How many roots lie above ``c``, for a polynomial whose roots are all real: sign changes at c."""
    a, d = list(poly), len(poly) - 1
    if c:
        for i in range(d):
            for j in range(d - 1, i - 1, -1):
                a[j] += c * a[j + 1]
    signs = [v > 0 for v in a if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _value(poly: list[int], c: int) -> int:
    total = 0
    for a in reversed(poly):
        total = total * c + a
    return total


def largest_roots(poly: list[int], top: int, most: int) -> tuple[list[int], int]:
    """Up to ``most`` positive roots in falling order, times ``2**bits``, rounded down; and bits.

    ``top`` is no less than any root.  Equal roots come as often as they count.
    """
    d, bits = len(poly) - 1, most * top.bit_length() + 64
    poly = [a << (bits * (d - j)) for j, a in enumerate(poly)]
    found: list[int] = []
    known = {0: roots_above(poly, 0), (top << bits) + 1: 0}

    def above(c: int) -> int:
        if c not in known:
            known[c] = roots_above(poly, c)
        return known[c]

    for k in range(min(most, known[0])):
        # The k-th root, from 0, lies above lo and not above hi.
        lo = max(c for c, n in known.items() if n > k)
        hi = min(c for c, n in known.items() if n <= k)
        while hi - lo > 1 and above(lo) - above(hi) > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if above(mid) > k else (lo, mid)
        if hi - lo > 1 and _value(poly, hi):
            positive = _value(poly, hi) > 0
            while hi - lo > 1:  # alone in there: its sign tells
                mid = (lo + hi) // 2
                value = _value(poly, mid)
                lo, hi = (lo, mid) if value == 0 or (value > 0) == positive else (mid, hi)
        found.append(hi if hi - lo > 1 else (hi if not _value(poly, hi) else lo))
    return found, bits


# ---------------------------------------------------------------- components


def _factored(a: list[list[Decimal]], tiny: Decimal) -> tuple[list[list[Decimal]], list[int]]:
    d, order = len(a), list(range(len(a)))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[pivot] = a[pivot], a[k]
        order[k], order[pivot] = order[pivot], order[k]
        if not a[k][k]:
            a[k][k] = tiny
        own = a[k]
        for i in range(k + 1, d):
            row = a[i]
            if row[k]:
                f = row[k] / own[k]
                row[k] = f
                row[k + 1 :] = [x - f * y for x, y in zip(row[k + 1 :], own[k + 1 :], strict=True)]
    return a, order


def _solved(factors: list[list[Decimal]], order: list[int], b: list[Decimal]) -> list[Decimal]:
    d = len(b)
    x = [b[i] for i in order]
    for i in range(d):
        x[i] -= sum((f * v for f, v in zip(factors[i][:i], x, strict=False)), Decimal(0))
    for i in reversed(range(d)):
        rest = sum((f * v for f, v in zip(factors[i][i + 1 :], x[i + 1 :], strict=True)), Decimal(0))
        x[i] = (x[i] - rest) / factors[i][i]
    return x


def _unit(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    for u in others:
        along = sum((x * y for x, y in zip(u, v, strict=True)), Decimal(0))
        v = [y - along * x for x, y in zip(u, v, strict=True)]
    size = sum((x * x for x in v), Decimal(0)).sqrt()
    v = [x / size for x in v]
    lead = max(v, key=abs)
    return [-x for x in v] if lead < 0 else v


def null_vectors(matrix: list[list[int]], roots: list[Decimal], digits: int) -> list[list[Decimal]]:
    """Unit vectors of the null spaces of the matrix less each root, its largest entry positive."""
    d, tiny, found, last = len(matrix), Decimal(10) ** (-2 * digits), [], None
    for k, root in enumerate(roots):
        if root != last:
            own: list[list[Decimal]] = []
            shifted = [[Decimal(v) - root if i == j else Decimal(v) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
            factors, order = _factored(shifted, tiny)
        v = _unit([Decimal((i + 1) * (2 * k + 3) * 7919 % 1009 + 1) for i in range(d)], own)
        for _ in range(3):
            v = _unit(_solved(factors, order, v), own)
        own.append(v)
        found.append(v)
        last = root
    return found


# ---------------------------------------------------------------- the operator


@dataclass
class Whitening:
    """``n`` vectors fitted, their ``sums``, and per component: unit vector, eigenvalue, its share of the trace."""

    dims: int = 0
    n: int = 0
    sums: list[int] = field(default_factory=list)
    vectors: list[list[float]] = field(default_factory=list)
    eigenvalues: list[float] = field(default_factory=list)
    explained: list[float] = field(default_factory=list)
    identity_error: float = 0.0
    scale: int = SCALE


def decompose(n: int, sums: list[int], products: list[list[int]], most: int, scale: int = SCALE) -> Whitening:
    """The whitening of ``n`` integer vectors from their sums and sums of products."""
    d = len(sums)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(matrix[i][i] for i in range(d))
    model = Whitening(dims=d, n=n, sums=sums, scale=scale)
    if not trace:
        return model
    common = math.gcd(*[v for row in matrix for v in row])
    matrix = [[v // common for v in row] for row in matrix]
    trace //= common
    scaled, bits = largest_roots(characteristic_polynomial(matrix), trace, min(most, d))
    digits = bits // 3 + 40
    with localcontext() as context:
        context.prec = digits
        roots = [Decimal(r) / (1 << bits) for r in scaled]
        model.vectors = [[float(x) for x in v] for v in null_vectors(matrix, roots, digits)]
        values = [r * common / (n * n) for r in roots]
        model.eigenvalues = [float(e) for e in values]
        model.explained = [float(r / trace) for r in roots]
        # The covariance of what the doubles give, from the integers.
        exact = [[Decimal(x) for x in v] for v in model.vectors]
        worst = Decimal(0)
        for i, u in enumerate(exact):
            image = [sum((m * x for m, x in zip(row, u, strict=True)), Decimal(0)) for row in matrix]
            for j, v in enumerate(exact):
                spread = sum((x * y for x, y in zip(image, v, strict=True)), Decimal(0)) * common / (n * n)
                spread /= (Decimal(model.eigenvalues[i]) * Decimal(model.eigenvalues[j])).sqrt()
                worst = max(worst, abs(spread - (i == j)))
        model.identity_error = float(worst)
    return model


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening:
    """The whitening of the distinct integer vectors; writes them to the shared folder, runs three jobs."""
    spark = rows.sparkSession
    ship(spark)
    vectors = rows.select(F.col(vector_col).cast("array<double>").alias("vector"))
    keys = vectors.mapInArrow(lambda batches: _keys(batches, scale), "key binary").distinct()
    width = F.conv(F.hex(F.substring("key", 1, 1)), 16, 10).cast("bigint")
    dims = ((F.octet_length("key") - 1) / width).cast("int")
    keys = stage(keys.withColumn("dims", dims), f"{run_folder(spark)}/vectors")
    lengths = keys.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1)
    common = lengths.collect()
    if not common:
        return Whitening(scale=scale)
    d = common[0].dims
    sums = keys.where(F.col("dims") == d).select("key").mapInArrow(
        lambda batches: _sums(batches, d), "cell bigint, place bigint, part bigint"
    )
    cells = [0] * (1 + d + d * (d + 1) // 2)
    for r in sums.groupBy("cell", "place").agg(F.sum("part").alias("part")).collect():
        cells[r.cell] += r.part << (_LIMB * r.place)
    products = [[0] * d for _ in range(d)]
    for i, j, v in zip(*np.triu_indices(d), cells[1 + d :], strict=True):
        products[i][j] = products[j][i] = v
    return decompose(cells[0], cells[1 : 1 + d], products, components, scale)


def _decimals(values: list[int]) -> pa.Array:
    low = np.array([v & ((1 << 64) - 1) for v in values], np.uint64)
    high = np.array([min(v >> 64, (1 << 63) - 1) for v in values], np.uint64)
    fits = pa.array([v < 10**38 for v in values], pa.bool_())
    buffer = pa.py_buffer(np.stack([low, high], axis=1).tobytes())
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(values), [fits.buffers()[1], buffer])


def _whiten(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    n, sums = model.n, np.array(model.sums, object)
    axes = np.array(model.vectors, np.float64).T / np.sqrt(np.array(model.eigenvalues)) / n
    constant, widest = sum(s * s for s in model.sums), max(map(abs, model.sums))
    for batch in batches:
        for rows, x in integers(batch.column(1), model.scale):
            if x.shape[1] != model.dims:
                continue
            most = int(max(x.max(), -x.min()))
            y = x * n - sums.astype(np.int64) if max(most * n, widest) < _EXACT else x.astype(object) * n - sums
            if max(most * n, widest) ** 2 * 4 * model.dims < 1 << 63:
                deviations = (y * y).sum(axis=1).tolist()
            else:  # the same sum multiplied out, in integers of any size
                fits = most * max(most, widest) * model.dims < 1 << 63
                own, sides = (x, sums.astype(np.int64)) if fits else (x.astype(object), sums)
                squares, along = (own * own).sum(axis=1).tolist(), (own * sides).sum(axis=1).tolist()
                deviations = [n * n * a - 2 * n * b + constant for a, b in zip(squares, along, strict=True)]
            values = y.astype(np.float64) @ axes
            offsets = np.arange(len(values) + 1, dtype=np.int32) * axes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    _decimals(deviations),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1))),
                ],
                ["id", "deviation", "whitened"],
            )


def whiten(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id``, ``deviation`` (sum of ``(n*x - S)**2``, null from 10**38) and ``whitened`` of the valid rows."""
    spark = rows.sparkSession
    ship(spark)
    given = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    shape = given.select(
        "id",
        F.lit(0).cast("decimal(38,0)").alias("deviation"),
        F.lit(None).cast("array<double>").alias("whitened"),
    ).schema
    if not model.vectors:
        return spark.createDataFrame([], shape)
    return given.mapInArrow(lambda batches: _whiten(batches, model), shape)


def by_component(whitened: DataFrame, model: Whitening) -> DataFrame:
    """One row per row and component; a deviation that no long can hold is null."""
    shares = F.array(*[F.lit(v) for v in model.explained]).cast("array<double>")
    return whitened.select(
        "id", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("k", "whitened")
    ).select(
        "id",
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("k")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
