"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another; the model of a category sees the text and
the log-odds of the categories before it.  Those inputs come from out-of-fold
predictions while it is trained (each fold's by a model that has not seen the fold),
so it learns how far the earlier models can be trusted on new texts, and from the
final earlier models when it predicts.

The text's features are present or absent: its words, their first four, five and six
bytes (stems carry most of the insults), and coarse measures of its shape (share of
capitals, digits and marks, repeated words, length), each known by a 64-bit hash.
Models are logistic, with an L1 penalty that leaves few weights; one toxic word in a
very long text decides as much as in a short one.

Training takes at most ``SAMPLE_DOCS`` labelled documents per class of the last
category, of at most ``SAMPLE_BYTES`` each, chosen by hash among those whose
``crc32(id as text) mod 3`` is not 1 and weighted back to the true class sizes; these
bounds are the only ones.  Every document is then scored where it is, over its whole
text, with the broadcast weights.

Defined cases: null and empty texts have shape features only and are scored; labels
that are null count as no label, a document labelled twice is taken with its largest
labels; without labelled documents of both classes a category has probability 0; a
null id is not learned from; repeated rows are reported each time; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.shared import by_hash, lists, lowered, ship, span_hashes, spans_of, text_parts

SAMPLE_DOCS = 2_500
SAMPLE_BYTES = 8_192
FOLDS = 3
ROUNDS = 200
PENALTY = 0.3  # over the root of the number of documents
PART = 1 << 18

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and stem of some texts, and of every text's shape."""
    starts, ends = spans_of(_LETTER[data], bounds)
    low = lowered(data)
    text = np.searchsorted(bounds, starts, "right") - 1
    length = ends - starts
    whole = span_hashes(low, starts, ends)
    hashes, texts = [whole], [text]
    for n in (4, 5, 6):
        fits = length > n
        stem = span_hashes(low, starts[fits], starts[fits] + n)
        hashes.append(stem ^ np.uint64(n * 0x9E3779B97F4A7C15 % 2**64))
        texts.append(text[fits])
    n_texts = len(bounds) - 1

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    size = np.maximum(np.diff(bounds), 1)
    words = np.bincount(text, minlength=n_texts)
    mark = ~(_LETTER[data] | _DIGIT[data] | _SPACE[data])
    key = np.unique(np.stack([text.astype(np.uint64), whole], axis=1), axis=0)[:, 0] if len(text) else text
    distinct = np.bincount(key.astype(np.int64), minlength=n_texts)
    shapes = [
        np.minimum(total(_CAPITAL[data]) * 20 // size, 7),
        np.minimum(total(mark) * 40 // size, 7),
        np.minimum(total(_DIGIT[data]) * 20 // size, 7),
        np.minimum(distinct * 8 // np.maximum(words, 1), 7),
        np.minimum(np.log2(words + 1).astype(np.int64), 15),
        np.minimum(total(_LETTER[data]) // np.maximum(words, 1), 15),
    ]
    at = 0
    for shape, n in zip(shapes, (8, 8, 8, 8, 16, 16), strict=True):
        hashes.append((at + shape).astype(np.uint64))
        texts.append(np.arange(n_texts))
        at += n
    return np.concatenate(texts), np.concatenate(hashes)


def once(texts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every feature once per text, in order of text."""
    order = np.lexsort((hashes, texts))
    texts, hashes = texts[order], hashes[order]
    new = np.ones(len(texts), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
    return texts[new], hashes[new]


@dataclass
class Linear:
    """Weights of the features with the (sorted) hashes, and of earlier log-odds."""

    hashes: np.ndarray
    weights: np.ndarray
    chained: np.ndarray
    bias: float

    def odds(self, texts: np.ndarray, hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(at), bool)
        flat = np.bincount(texts[known], self.weights[at[known]], minlength=len(before))
        return np.clip(flat + before @ self.chained + self.bias, -50, 50)


def fit(
    texts: np.ndarray, hashes: np.ndarray, before: np.ndarray, truth: np.ndarray,
    importance: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY,
) -> Linear:
    """Logistic regression by adaptive proximal gradient steps.

    Both classes weigh the same while an L1 penalty picks the features, and while the
    picked ones are fitted again almost without it; the odds are then moved to the true
    class sizes.
    """
    used, weights = hashes[:0], np.zeros(0)
    chained, bias = np.zeros(before.shape[1]), 0.0
    sizes = (importance * (1 - truth)).sum(), (importance * truth).sum()
    if not min(sizes):
        return Linear(used, weights, chained, 50.0 if sizes[1] else -50.0)
    scale = importance * np.where(truth == 1, 0.5 / sizes[1], 0.5 / sizes[0])
    limit = penalty / np.sqrt(min((importance > 0).sum(), 4 * (importance * truth > 0).sum()))
    # Features whose pull at the start is far below the penalty stay at zero.
    used, number = np.unique(hashes, return_inverse=True)
    strong = np.abs(np.bincount(number, (scale * (truth - 0.5))[texts], len(used))) >= limit / 2
    weights = np.zeros(len(used))
    for again in (False, True):
        texts, number = texts[strong[number]], (np.cumsum(strong) - 1)[number[strong[number]]]
        used, weights = used[strong], weights[strong]
        press = limit / 50 if again else limit
        sums = [np.full(len(used), 1e-8), np.full(len(chained), 1e-8), 1e-8]
        for _ in range(rounds * (1 + again)):
            odds = np.bincount(texts, weights[number], minlength=len(before))
            odds = np.clip(odds + before @ chained + bias, -50, 50)
            error = scale * (truth - 1 / (1 + np.exp(-odds)))
            grad = np.bincount(number, error[texts], len(used))
            sums[0] += grad * grad
            step = 0.5 / np.sqrt(sums[0])
            moved = weights + step * grad
            weights = np.sign(moved) * np.maximum(np.abs(moved) - step * press, 0)
            grad = error @ before
            sums[1] += grad * grad
            chained = chained + 0.05 * grad / np.sqrt(sums[1])
            grad = float(error.sum())
            sums[2] += grad * grad
            bias += 0.1 * grad / np.sqrt(sums[2])
        strong = weights != 0
    return Linear(used[strong], weights[strong], chained, bias + float(np.log(sizes[1] / sizes[0])))


def fit_chain(
    texts: np.ndarray, hashes: np.ndarray, labels: np.ndarray, folds: np.ndarray,
    importance: np.ndarray,
) -> list[Linear]:
    """One model per column of labels; later ones see out-of-fold log-odds of earlier ones."""
    _, number, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    common = counts[number] > 2  # the rest cannot generalise
    texts, hashes = texts[common], hashes[common]
    before = np.zeros((len(labels), 0))
    chain = []
    for c in range(labels.shape[1]):
        truth = labels[:, c]
        chain.append(fit(texts, hashes, before, truth, importance))
        if c + 1 == labels.shape[1]:
            break
        unseen = np.zeros(len(labels))
        for f in np.unique(folds):
            rest = folds != f
            inside = rest[texts]
            part = fit(texts[inside], hashes[inside], before, truth, importance * rest)
            unseen[~rest] = part.odds(texts, hashes, before)[~rest]
        before = np.column_stack([before, np.clip(unseen, -10, 10)])
    return chain


def apply_chain(
    chain: list[Linear], texts: np.ndarray, hashes: np.ndarray, n: int
) -> np.ndarray:
    """Probability of each category for each text."""
    known = np.concatenate([m.hashes for m in chain])
    useful = np.zeros(1 << 16, bool)
    useful[known & np.uint64(0xFFFF)] = True
    keep = useful[hashes & np.uint64(0xFFFF)]
    texts, hashes = once(texts[keep], hashes[keep])
    before, out = np.zeros((n, 0)), []
    for model in chain:
        odds = model.odds(texts, hashes, before)
        out.append(1 / (1 + np.exp(-odds)))
        before = np.column_stack([before, np.clip(odds, -10, 10)])
    return np.column_stack(out)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in text_parts(batch.column("text"), PART):
            texts, hashes = once(*features(data, bounds))
            counts = np.bincount(texts, minlength=hi - lo)
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("labels"), lists(pa.array(hashes.view(np.int64)), counts)],
                ["id", "labels", "hashes"],
            )


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    sample_bytes: int = SAMPLE_BYTES,
) -> list[Linear]:
    """Learn the chain; ``categories`` maps names, in chain order, to SQL over the labels."""
    spark = docs.sparkSession
    ship(spark)
    flags = [F.expr(c).cast("boolean").cast("int").alias(n) for n, c in categories.items()]
    known = labels.select(F.col(id_col).alias("id"), *flags).dropna()
    known = known.groupBy("id").agg(F.array(*[F.max(n) for n in categories]).alias("labels"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where(
        (F.crc32(F.col("id").cast("string")) % 3 != 1)
        & (F.coalesce(F.octet_length("text"), F.lit(0)) <= sample_bytes)
    )
    last = F.element_at("labels", -1)
    ids = rows.select("id").join(known, "id").withColumn("last", last)
    sizes = {r["last"]: r["n"] for r in ids.groupBy("last").agg(F.count("*").alias("n")).collect()}
    chosen = by_hash(ids, "id", "last", sample_docs)
    chosen = chosen.select("id", "labels").distinct()
    sample = rows.join(F.broadcast(chosen), "id").select("id", "labels", "text")
    schema = sample.select("id", "labels", F.lit(None).cast("array<bigint>").alias("hashes")).schema
    found = sample.mapInArrow(_featured, schema).toArrow().sort_by("id").combine_chunks()
    truth = np.array(found.column("labels").to_pylist(), float).reshape(-1, len(categories))
    hashes = found.column("hashes").combine_chunks()
    texts = np.repeat(np.arange(len(truth)), np.diff(hashes.offsets))
    flat = hashes.flatten().to_numpy().view(np.uint64)
    taken = {c: max((truth[:, -1] == c).sum(), 1) for c in (0, 1)}
    importance = np.where(truth[:, -1] == 1, sizes.get(1, 0) / taken[1], sizes.get(0, 0) / taken[0])
    folds = np.array([hash_fold(i) for i in found.column("id").to_pylist()], np.int64)
    return fit_chain(texts, flat, truth, folds, importance)


def hash_fold(value: int) -> int:
    return (int(value) * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % FOLDS


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    chain = [Linear(*parts) for parts in shared.value]
    for batch in batches:
        for lo, hi, data, bounds in text_parts(batch.column("text"), PART):
            out = apply_chain(chain, *features(data, bounds), hi - lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(lo, hi - lo)] + [pa.array(c.copy()) for c in out.T],
                ["id", *(f"p{i}" for i in range(out.shape[1]))],
            )


def score(
    docs: DataFrame,
    chain: list[Linear],
    categories: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id`` and ``p_<category>`` of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast([(m.hashes, m.weights, m.chained, m.bias) for m in chain])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    zero = F.lit(0.0)
    schema = rows.select("id", *[zero.alias(f"p{i}") for i in range(len(chain))]).schema
    made = rows.mapInArrow(lambda batches: _score(batches, shared), schema)
    return made.withColumnsRenamed({f"p{i}": f"p_{n}" for i, n in enumerate(categories)})
