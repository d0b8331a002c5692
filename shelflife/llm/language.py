"""Language ID: a linear-chain conditional random field over the words of a text.

Every word of a text gets a language; neighbours influence each other through learned
transitions, so a text may switch languages midway.  A word's evidence is the sum of
learned weights of its byte trigrams (word ends marked), of its affixes (first and
last two and three bytes), and of a lexicon: how often words of its hash were seen in
each language over all labelled documents, with a learned weight.  Words' posteriors
come from the forward-backward algorithm; a text's language is the one with the
largest sum of posteriors, its score the mean.

Learning uses documents with a language whose ``crc32(id as text) mod 3`` is not 1:
all of them for the lexicon (counted in ``SLOTS`` hash slots per language, summed in
the tasks before they are shuffled), and a window of ``WINDOW_WORDS`` words of
``SAMPLE_DOCS`` documents per language, chosen by hash, for the weights.  Windows are
spliced in pairs, so the chain meets changes of language.  The sample is the only part
that is bounded; the model has a fixed size per language and is broadcast.

Prediction maps texts to results where they are.  The chain runs over whole texts:
they are cut into blocks of ``BLOCK`` words, every block's transfer matrix is built at
once, messages pass between blocks, and all blocks are finished at once, which gives
exactly the posteriors of the uncut chain.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is
every text if no labelled document exists; a null id is neither learned from nor held
out; ties go to the first language in code point order; repeated rows are reported each
time; an empty table gives an empty result; only the text decides a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflife.llm.shared import by_hash, lowered, place_of, ship, span_hashes, spans_of, text_parts

SAMPLE_DOCS = 600  # per language
WINDOW_WORDS = 96
MAX_LANGS = 256  # more are refused: the model holds about a megabyte per language
SLOTS = 1 << 16
GRAMS = 1 << 16
BLOCK = 32
ROUNDS = 40
PART = 1 << 17

# Words are runs of ASCII letters, apostrophes and bytes beyond ASCII, in lower case.
_WORD = np.zeros(256, bool)
_WORD[97:123] = _WORD[128:] = _WORD[39] = True


@dataclass
class Words:
    """The words of some texts with their features, as flat arrays."""

    firsts: np.ndarray  # number of each text's first word, and the end
    grams: np.ndarray  # trigram numbers, word after word
    gram_firsts: np.ndarray  # where each word's trigrams begin
    affixes: np.ndarray  # four affix numbers per word
    slots: np.ndarray  # lexicon slot per word


def words_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    data = lowered(data)
    inside = _WORD[data]
    starts, ends = spans_of(inside, bounds)
    step = np.uint32(0x9E3779B1)
    lengths = ends - starts
    gram_firsts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    wide = data[inside].astype(np.uint32)
    # Beyond its ends a word has zeros, whatever stands beside it.
    left, right = np.zeros_like(wide), np.zeros_like(wide)
    left[1:], right[:-1] = wide[:-1], wide[1:]
    left[gram_firsts[:-1]] = 0
    right[gram_firsts[1:] - 1] = 0
    grams = (((left * step + wide) * step + right) * step >> np.uint32(16)).astype(np.int64)
    padded = np.append(data, 0).astype(np.uint32)
    cut = lambda i, back: np.where(np.abs(back) < lengths, padded[i], np.uint32(0))
    p = [cut(np.minimum(starts + j, len(data)), j) for j in range(3)]
    s = [cut(np.maximum(ends - 1 - j, 0), j) for j in range(3)]
    mixes = [
        (p[0] * step + p[1]) * step + np.uint32(11),
        ((p[0] * step + p[1]) * step + p[2]) * step + np.uint32(12),
        (s[0] * step + s[1]) * step + np.uint32(13),
        ((s[0] * step + s[1]) * step + s[2]) * step + np.uint32(14),
    ]
    affixes = np.stack([(m * step >> np.uint32(16)).astype(np.int64) for m in mixes], axis=1)
    slots = (span_hashes(data, starts, ends) >> np.uint64(48)).astype(np.int64)
    return Words(np.searchsorted(starts, bounds), grams, gram_firsts, affixes, slots)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # GRAMS rows of trigram weights, then GRAMS rows of affix weights
    lexicon: np.ndarray  # SLOTS rows of centred log frequencies
    lexicon_weight: float
    transitions: np.ndarray


def scores(words: Words, weights: np.ndarray, lexicon: np.ndarray, lexicon_weight: float) -> np.ndarray:
    """Evidence of every word for every language."""
    n = len(words.slots)
    if not n:
        return np.zeros((0, weights.shape[1]), np.float32)
    out = np.add.reduceat(weights[words.grams], words.gram_firsts[:-1], axis=0)
    for j in range(words.affixes.shape[1]):
        out += weights[GRAMS + words.affixes[:, j]]
    return out + lexicon_weight * lexicon[words.slots]


def posteriors(evidence: np.ndarray, firsts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Sum of the posteriors of each text's words, by blocks of the chain."""
    n_texts, k = len(firsts) - 1, evidence.shape[1]
    sums = np.zeros((n_texts, k))
    counts = np.diff(firsts)
    blocks = -(-counts // BLOCK)
    n = int(blocks.sum())
    if not n:
        return sums
    emit = np.exp(evidence - evidence.max(axis=1, keepdims=True)).astype(np.float32) + np.float32(1e-12)
    move = np.exp(transitions - transitions.max()).astype(np.float32)
    text = np.repeat(np.arange(n_texts), blocks)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    rank = np.arange(n) - first_block[text]
    begin = firsts[text] + rank * BLOCK
    length = np.minimum(firsts[text + 1] - begin, BLOCK)
    # Longest blocks first, so that step t touches a prefix.
    order = np.argsort(-length, kind="stable")
    begin, length, text, rank = begin[order], length[order], text[order], rank[order]
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    live = [int(np.searchsorted(-length, -t, "left")) for t in range(BLOCK)]

    transfer = np.broadcast_to(np.eye(k, dtype=np.float32), (n, k, k)).copy()
    several = bool((blocks > 1).any())
    for t in range(BLOCK if several else 0):
        m = live[t]
        if not m:
            break
        part = transfer[:m] @ move * emit[begin[:m] + t][:, None, :]
        transfer[:m] = part / part.sum(axis=(1, 2), keepdims=True)
    ahead = np.full((n, k), 1 / k, np.float32)
    behind = np.full((n, k), 1 / k, np.float32)
    longest = int(blocks.max())
    by_size = np.argsort(-blocks, kind="stable")
    sizes = blocks[by_size]
    for r in range(1, longest):
        here = first_block[by_size[: int(np.searchsorted(-sizes, -r, "left"))]]
        a, b = where[here + r - 1], where[here + r]
        message = (ahead[a][:, None, :] @ transfer[a])[:, 0, :]
        ahead[b] = message / message.sum(axis=1, keepdims=True)
    for r in range(longest - 1, 0, -1):
        here = first_block[by_size[: int(np.searchsorted(-sizes, -r, "left"))]]
        a, b = where[here + r - 1], where[here + r]
        message = (transfer[b] @ behind[b][:, :, None])[:, :, 0]
        behind[a] = message / message.sum(axis=1, keepdims=True)

    alphas, now = [], ahead.copy()
    for t in range(BLOCK):
        m = live[t]
        if not m:
            break
        part = now[:m] @ move * emit[begin[:m] + t]
        now[:m] = part / part.sum(axis=1, keepdims=True)
        alphas.append(now[:m].copy())
    total, now = np.zeros((n, k), np.float32), behind.copy()
    for t in range(len(alphas) - 1, -1, -1):
        m = live[t]
        both = alphas[t] * now[:m]
        total[:m] += both / both.sum(axis=1, keepdims=True)
        part = (now[:m] * emit[begin[:m] + t]) @ move.T
        now[:m] = part / part.sum(axis=1, keepdims=True)
    np.add.at(sums, text, total)
    return sums


def learned_from(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3 != 1


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = docs.where(F.col(lang_col).isNotNull() & learned_from(id_col))
    return rows.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )


def _count_words(batches: Iterator[pa.RecordBatch], langs: list[str]) -> Iterator[pa.RecordBatch]:
    number = {lang: i for i, lang in enumerate(langs)}
    cells = np.zeros(SLOTS * len(langs), np.int64)
    for batch in batches:
        own = np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
        for lo, hi, data, bounds in text_parts(batch.column("text"), PART):
            words = words_of(data, bounds)
            lang = np.repeat(own[lo:hi], np.diff(words.firsts))
            cell = (words.slots * len(langs) + lang)[lang >= 0]
            cells += np.bincount(cell, minlength=len(cells))
    at = np.flatnonzero(cells)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], ["cell", "n"])


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A window of words of each document, at a place that its text decides."""
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            words = text.split()
            start = len(text) * 2654435761 % 2**31 % max(len(words) - WINDOW_WORDS, 1)
            out.append(" ".join(words[start : start + WINDOW_WORDS]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(out, pa.string()), batch.column("lang")],
            ["id", "text", "lang"],
        )


def centred(counts: np.ndarray) -> np.ndarray:
    """Log relative frequency of each slot per language, less its mean over languages."""
    smooth = (counts + 0.5) / (counts.sum(axis=0, keepdims=True) + 0.5 * len(counts))
    logs = np.log(smooth)
    return (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


def fit(texts: list[str], labels: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Weights and transitions that maximise the likelihood of the spliced windows."""
    k = counts.shape[1]
    data = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    words = words_of(np.frombuffer(b"".join(data), np.uint8), bounds)
    own = np.repeat(labels, np.diff(words.firsts))
    # A word must not be known from its own occurrence.
    logs = np.log(counts + 0.5)
    mine = np.log(np.maximum(counts[words.slots, own] - 1, 0) + 0.5)
    lexicon = logs[words.slots]
    lexicon[np.arange(len(own)), own] = mine
    lexicon -= np.log(counts.sum(axis=0) + 0.5 * len(counts))
    lexicon = (lexicon - lexicon.mean(axis=1, keepdims=True)).astype(np.float32)
    # Two windows in a row make one chain.
    firsts = np.unique(np.append(words.firsts[::2], words.firsts[-1]))
    lengths = np.diff(firsts)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = firsts[:-1][order], lengths[order]
    live = [int(np.searchsorted(-lengths, -t, "left")) for t in range(int(lengths.max(initial=0)))]
    truth = np.zeros((len(own), k), np.float32)
    truth[np.arange(len(own)), own] = 1
    of_gram = np.repeat(np.arange(len(own)), np.diff(words.gram_firsts))

    weights = np.zeros((2 * GRAMS, k), np.float32)
    transitions = np.zeros((k, k), np.float32)
    lexicon_weight = 0.5
    sum_w, sum_t, sum_l = np.full_like(weights, 1e-6), np.full_like(transitions, 1e-6), 1e-6
    n = max(len(own), 1)
    for _ in range(rounds):
        evidence = np.add.reduceat(weights[words.grams], words.gram_firsts[:-1], axis=0)
        for j in range(words.affixes.shape[1]):
            evidence += weights[GRAMS + words.affixes[:, j]]
        evidence += np.float32(lexicon_weight) * lexicon
        emit = np.exp(evidence - evidence.max(axis=1, keepdims=True)) + np.float32(1e-12)
        move = np.exp(transitions - transitions.max())
        alphas, now = [], np.full((len(begin), k), 1 / k, np.float32)
        for t, m in enumerate(live):
            part = now[:m] @ move * emit[begin[:m] + t]
            now[:m] = part / part.sum(axis=1, keepdims=True)
            alphas.append(now[:m].copy())
        marginal = np.zeros_like(truth)
        pairs, seen = np.zeros((k, k)), np.zeros((k, k))
        now = np.full((len(begin), k), 1 / k, np.float32)
        for t in range(len(live) - 1, -1, -1):
            m = live[t]
            both = alphas[t] * now[:m]
            marginal[begin[:m] + t] = both / both.sum(axis=1, keepdims=True)
            onward = now[:m] * emit[begin[:m] + t]
            if t:
                joint = alphas[t - 1][:m, :, None] * move[None] * onward[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                np.add.at(seen, (own[begin[:m] + t - 1], own[begin[:m] + t]), 1)
            part = onward @ move.T
            now[:m] = part / part.sum(axis=1, keepdims=True)
        error = truth - marginal
        grad = np.empty_like(weights)
        for c in range(k):
            grad[:GRAMS, c] = np.bincount(words.grams, error[of_gram, c], GRAMS)
            flat = np.repeat(error[:, c], words.affixes.shape[1])
            grad[GRAMS:, c] = np.bincount(words.affixes.ravel(), flat, GRAMS)
        grad = grad / n - 1e-6 * weights
        grad_t = ((seen - pairs) / n - 1e-5 * transitions).astype(np.float32)
        grad_l = float((error * lexicon).sum()) / n
        sum_w += grad * grad
        sum_t += grad_t * grad_t
        sum_l += grad_l * grad_l
        weights += 0.25 * grad / np.sqrt(sum_w)
        transitions += 0.25 * grad_t / np.sqrt(sum_t)
        lexicon_weight += 0.1 * grad_l / np.sqrt(sum_l)
    return Model([], weights, centred(counts), float(lexicon_weight), transitions)


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
) -> Model | None:
    """Learn from the labelled documents; None if there are none."""
    spark = docs.sparkSession
    ship(spark)
    rows = _labelled(docs, id_col, text_col, lang_col)
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGS + 1).collect())
    if not langs:
        return None
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    cells = rows.select("text", "lang").mapInArrow(
        lambda batches: _count_words(batches, langs), "cell bigint, n bigint"
    )
    total = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS * len(langs))
    counts[total["cell"].to_numpy()] = total["n"].to_numpy()
    chosen = by_hash(rows.select("id", "lang"), "id", "lang", sample_docs)
    chosen = rows.join(F.broadcast(chosen), ["id", "lang"], "left_semi")
    chosen = chosen.select("id", "text", "lang")
    sample = chosen.mapInArrow(_sample, chosen.schema).toArrow().to_pylist()
    sample.sort(key=lambda r: (span_key(r["id"]), r["id"], r["text"]))
    labels = np.array([langs.index(r["lang"]) for r in sample], np.int64)
    texts = [r["text"] for r in sample]
    model = fit(texts, labels, counts.reshape(SLOTS, len(langs)))
    model.langs = langs
    return model


def span_key(value: int) -> int:
    """A number that scatters neighbouring ids, the same on every run."""
    return int(value) * 0x9E3779B97F4A7C15 % (1 << 64)


def _predict(batches: Iterator[pa.RecordBatch], shared, held: int | None) -> Iterator[pa.RecordBatch]:
    """The text is field ``held`` of ``doc``, if any."""
    langs, weights, lexicon, lexicon_weight, transitions = shared.value
    names = np.array(langs, object)
    for batch in batches:
        texts = batch.column("text") if held is None else batch.column("doc").field(held)
        for lo, hi, data, bounds in text_parts(texts, PART):
            words = words_of(data, bounds)
            evidence = scores(words, weights, lexicon, lexicon_weight)
            sums = posteriors(evidence, words.firsts, transitions)
            n = np.diff(words.firsts)
            best = sums.argmax(axis=1)
            share = sums[np.arange(hi - lo), best] / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").slice(lo, hi - lo),
                    batch.column("id").slice(lo, hi - lo),
                    batch.column("letters").slice(lo, hi - lo),
                    pa.array(names[best], pa.string()),
                    pa.array(np.clip(share, 0, 1)),
                ],
                ["doc", "id", "letters", "lang_pred", "score"],
            )


def predict(
    docs: DataFrame,
    model: Model | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_doc: bool = False,
) -> DataFrame:
    """``id``, ``held_out``, ``lang_pred`` and ``score`` of every row.

    ``with_doc`` adds ``doc``, all columns of the row as a struct.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.col(text_col).cast("string")
    held = place_of(docs, text_col) if with_doc else None
    rows = docs.select(
        (F.struct("*") if with_doc else F.struct(F.lit(0).alias("none"))).alias("doc"),
        F.col(id_col).alias("id"),
        *([text.alias("text")] if held is None else []),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    if model is None:
        made = rows.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    else:
        parts = (model.langs, model.weights, model.lexicon, model.lexicon_weight, model.transitions)
        shared = spark.sparkContext.broadcast(parts)
        schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).drop("text").schema
        made = rows.mapInArrow(lambda batches: _predict(batches, shared, held), schema)
    return made.select(
        *(["doc"] if with_doc else []),
        "id",
        F.coalesce(~learned_from("id"), F.lit(False)).alias("held_out"),
        F.when(F.col("letters"), F.col("lang_pred")).otherwise(F.lit("und")).alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(F.lit(0.0)).alias("score"),
    )
