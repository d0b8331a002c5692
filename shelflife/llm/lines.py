"""Quality rules, line first: rules judge lines, then the document by what they took.

Every line with a word is held against three rules:

* punctuation: it holds the end of a sentence, and at most three of ten words come with a
  run of symbols or of repeated marks;
* navigation: it is not a row of links, that is separators with few words between them,
  nor made of the words of menus alone;
* boilerplate: as a short line it holds no notice (licence, copyright, consent, sign-up).

Lines that fail one go; blank lines stay.  A document that loses more than ``MAX_LOST``
percent of the characters of its words is rejected, as is one that fails the base rules:
too few words, or too many of them in word windows that the text repeats.

Rows stay where they are: nothing is shuffled, and a task holds one part of a batch, some
half a megabyte or one text.  Words and lines are numbered by a dictionary of the part, so
repeats are exact, and a window is a number made of its words' numbers.

Defined cases: null is the empty text; a text without words fails the base rules and has
nothing to lose; a text of any length is judged whole; rows that repeat an id are each
judged; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.shared import ship, spans_of, text_parts

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
MAX_LOST = 50  # percent of the characters of words
WINDOW = 3
NOTICE_WORDS = 30

#: The patterns of the rules, in the syntax of RE2.
SPACE = r"[\x20\x09-\x0D]"
SENTENCE_END = rf"[.!?…。！？][\"'”’»)\]]*({SPACE}|$)"
MARKS = r"[#*$%&|<>{}\[\]~^_=+@\\]+|[!?.,;:]{2,}"
SEPARATORS = r"[|»›•→]|::"
MENU = (
    rf"(?i)^{SPACE}*(home|menu|search|log ?in|log ?out|sign ?in|sign ?up|register|contact|about|about us"
    rf"|next|previous|back|top|share|print|more|read more|skip to content|sitemap|help|faq|news)"
    rf"([ /,>-]+(home|menu|search|login|logout|contact|about|next|previous|back|top|share|print|more"
    rf"|sitemap|help|faq|news))*[.!?]?{SPACE}*$"
)
NOTICE = (
    r"(?i)all rights reserved|copyright|©|cookie|privacy policy|terms of (use|service)|javascript"
    r"|licensed under|released under|subscribe to|newsletter|click here|lorem ipsum"
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "punctuation_lines", "navigation_lines", "boilerplate_lines", "lost_chars",
]


def _strings(kind: pa.DataType, data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An array of values that lie end to end in ``data``."""
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _numbers(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same number for equal values, by a dictionary."""
    if not len(sizes):
        return np.empty(0, np.int64)
    coded = _strings(pa.large_binary(), data, sizes).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers, the same for equal pairs."""
    return np.unique(left * (right.max(initial=0) + 1) + right, return_inverse=True)[1].reshape(-1)


def repeated_words(owner: np.ndarray, words: np.ndarray, width: int) -> np.ndarray:
    """Which words lie in a window of ``width`` words that its text holds twice or more."""
    covered = np.zeros(len(words), bool)
    n = len(words) - width + 1
    if n < 1:
        return covered
    inside = np.flatnonzero(owner[:n] == owner[width - 1 :])
    window = owner[inside] - owner[0]
    for j in range(width):
        window = _joined(window, words[inside + j])
    often = inside[np.bincount(window)[window] > 1] if len(window) else inside
    for j in range(width):
        covered[often + j] = True
    return covered


def line_verdicts(lines: pa.Array, words: np.ndarray) -> dict[str, np.ndarray]:
    """Which lines fail each rule; ``words`` is how many words each line has."""

    def found(pattern: str) -> np.ndarray:
        return pc.match_substring_regex(lines, pattern).to_numpy(zero_copy_only=False).astype(bool)

    def times(pattern: str) -> np.ndarray:
        return pc.count_substring_regex(lines, pattern).to_numpy(zero_copy_only=False).astype(np.int64)

    some = words > 0
    separators = times(SEPARATORS)
    links = (separators >= 2) & (words <= 4 * (separators + 1))
    return {
        "punctuation": some & (~found(SENTENCE_END) | (10 * times(MARKS) > 3 * words)),
        "navigation": some & (links | found(MENU)),
        "boilerplate": some & (words <= NOTICE_WORDS) & found(NOTICE),
    }


def _part(data: np.ndarray, bounds: np.ndarray, with_text: bool) -> tuple[dict[str, np.ndarray], list[str]]:
    """Counts of each text of a part, and the texts without the lines that fail."""
    n = len(bounds) - 1
    blank = _BLANK[data]
    starts, ends = spans_of(~blank, bounds)
    owner = np.searchsorted(bounds, starts, "right") - 1
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~blank & ((data & 0xC0) != 0x80), out=heads[1:])
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_SYMBOL[data], out=symbols[1:])
    words = _numbers(data[~blank], ends - starts)
    repeats = repeated_words(owner, words, WINDOW)

    # Lines: each text begins one, each line break another.
    breaks = np.flatnonzero(data == 10)
    line_owner = np.concatenate([np.arange(n), np.searchsorted(bounds, breaks, "right") - 1])
    line_start = np.concatenate([bounds[:-1], breaks + 1])
    order = np.lexsort([line_start, line_owner])
    line_owner, line_start = line_owner[order], line_start[order]
    last = np.append(line_owner[1:] != line_owner[:-1], True)
    line_end = np.where(last, bounds[line_owner + 1], np.append(line_start[1:] - 1, 0))
    sizes = line_end - line_start
    without = data[data != 10]
    line_words = np.searchsorted(starts, line_end) - np.searchsorted(starts, line_start)
    some = line_words > 0
    same = _joined(line_owner, _numbers(without, sizes))
    first = np.zeros(len(same), bool)
    first[np.unique(same, return_index=True)[1]] = True
    verdicts = line_verdicts(_strings(pa.large_string(), without, sizes), line_words)
    failed = np.zeros(len(some), bool)
    for verdict in verdicts.values():
        failed |= verdict
    chars = heads[line_end] - heads[line_start]

    def per_text(which: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        weights = None if weights is None else weights[which].astype(np.float64)
        return np.bincount(line_owner[which], weights, minlength=n).astype(np.int64)

    counts = {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": heads[bounds[1:]] - heads[bounds[:-1]],
        "n_symbols": symbols[bounds[1:]] - symbols[bounds[:-1]],
        "n_dup_lines": per_text(some & ~first),
        "n_repeat_words": np.bincount(owner[repeats], minlength=n),
        "n_lines": per_text(some),
        **{f"{name}_lines": per_text(verdict) for name, verdict in verdicts.items()},
        "lost_chars": per_text(failed, chars),
    }
    texts = []
    if with_text:
        kept: list[list[bytes]] = [[] for _ in range(n)]
        for i in np.flatnonzero(~failed):
            kept[line_owner[i]].append(data[line_start[i] : line_end[i]].tobytes())
        texts = [b"\n".join(parts).decode() for parts in kept]
    return counts, texts


def _judge(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in text_parts(batch.column(1)):
            counts, texts = _part(data, bounds, with_text)
            columns = [batch.column(0).slice(lo, hi - lo)]
            columns += [pa.array(counts[name].astype(np.int64)) for name in COUNTS]
            names = ["id", *COUNTS]
            if with_text:
                columns.append(pa.array(texts, pa.string()))
                names.append("cleaned")
            yield pa.RecordBatch.from_arrays(columns, names)


def judged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED,
    max_lost: int = MAX_LOST,
    with_text: bool = False,
) -> DataFrame:
    """``id``, the counts, ``base_failed``, ``kept`` and, if asked for, the ``cleaned`` text.

    One row per document row.  ``punctuation_lines`` and its like count the lines that fail
    a rule, a line under each rule that it fails; ``lost_chars`` the code points in the words
    of lines that fail any.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shape = rows.select("id", *[F.lit(0).cast("bigint").alias(name) for name in COUNTS])
    if with_text:
        shape = shape.withColumn("cleaned", F.lit(""))
    found = rows.mapInArrow(lambda batches: _judge(batches, with_text), shape.schema)
    repeated = F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeated) * F.col("n_words")
    lost = F.lit(100) * F.col("lost_chars") > F.lit(max_lost) * F.col("word_chars")
    return found.withColumn("base_failed", (F.col("n_words") < min_words) | repeated).withColumn(
        "kept", ~F.col("base_failed") & ~lost
    )


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the text that remains of the documents that are kept."""
    return judged(docs, id_col, text_col, with_text=True).where("kept").select("id", "cleaned")
