"""Token counts by offset-mapped attribution.

Every document is encoded once, as a whole, with a public byte-level tokenizer.  The
bytes of the tokens tile the text, so running sums of their lengths are the tokens'
spans.  Sections tile the text as well: lines with their line break, or pieces that
start at given character offsets.  The spans are joined to the sections as intervals,
by searching the section bounds, and a token that crosses a bound is allocated by rule:

* ``first``: to the section of its first byte,
* ``last``: to the section of its last byte,
* ``most``: to the section with most of its bytes, the first of several.

Counts of the sections of a document add up to its tokens under each rule.

The vocabulary file is read on the driver (its size is checked) and broadcast; texts
stay in place, nothing is shuffled, memory is one document beside a batch.

Defined cases: null and empty texts have one empty section without tokens; strings of
special tokens are ordinary text; section offsets may come unsorted, repeated, null or
outside the text and are then sorted, joined, or ignored, and a section always starts
at 0; repeated rows are reported each time; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.shared import lists, ship

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_BYTES = 64 * 1024 * 1024
#: Fixed value: the split that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[int, tuple[tiktoken.Encoding, np.ndarray]] = {}


def encoder(vocabulary: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a rank file, and the number of bytes of each token; made once a process."""
    key = hash((vocabulary, pattern))
    if key not in _encoders:
        ranks = {}
        for line in vocabulary.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        made = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _encoders[key] = made, sizes
    return _encoders[key]


def attribute(
    ends: np.ndarray, bounds: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many of them reach into another section.

    ``ends`` are the byte ends of tokens that tile the text, ``bounds`` the byte bounds
    of the sections, first and last included; sections may be empty.
    """
    n = len(bounds) - 1
    starts = np.concatenate([[0], ends])[:-1]
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends, "left") - 1
    if rule == "first":
        own = first
    elif rule == "last":
        own = last
    else:
        own, most = first.copy(), np.minimum(ends, bounds[first + 1]) - starts
        for step in range(1, int((last - first).max(initial=0)) + 1):
            here = first + step
            inside = np.flatnonzero(here <= last)
            h = here[inside]
            size = np.minimum(ends[inside], bounds[h + 1]) - np.maximum(starts[inside], bounds[h])
            more = size > most[inside]
            own[inside[more]], most[inside[more]] = h[more], size[more]
    crossing = np.bincount(own[first != last], minlength=n)
    return np.bincount(own, minlength=n), crossing


def section_bounds(text: np.ndarray, offsets: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the sections in bytes and in characters; ``offsets`` are in characters."""
    heads = np.flatnonzero((text & 0xC0) != 0x80)  # where each character begins
    if offsets is None:
        bounds = np.concatenate([[0], np.flatnonzero(text == 10) + 1, [len(text)]])
        bounds = np.unique(bounds) if len(text) else np.zeros(2, np.int64)
        return bounds, np.searchsorted(heads, bounds)
    chars = sorted({0, *(x for x in offsets if x is not None and 0 < x < len(heads))})
    places = np.append(heads, len(text))
    chars = np.array([*chars, len(heads)], np.int64)
    return places[chars], chars


_SECTION = pa.struct(
    [("start", pa.int64()), ("end", pa.int64()), ("tokens", pa.int64()), ("crossing", pa.int64())]
)


def _count(
    batches: Iterator[pa.RecordBatch], shared, pattern: str, rule: str
) -> Iterator[pa.RecordBatch]:
    encode, sizes = encoder(shared.value, pattern)
    for batch in batches:
        totals, counts, columns = [], [], [[], [], [], []]
        for text, offsets in zip(batch.column(1), batch.column(2), strict=True):
            text = text.as_py() or ""
            flat = np.frombuffer(text.encode(), np.uint8)
            bounds, chars = section_bounds(flat, offsets.as_py())
            ends = np.cumsum(sizes[np.array(encode.encode_ordinary(text), np.int64)])
            tokens, crossing = attribute(ends, bounds, rule)
            totals.append(len(ends))
            counts.append(len(bounds) - 1)
            for column, part in zip(
                columns, (chars[:-1], chars[1:], tokens, crossing), strict=True
            ):
                column.append(part)
        flat = [np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64) for c in columns]
        sections = pa.StructArray.from_arrays([pa.array(c) for c in flat], fields=list(_SECTION))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(totals, pa.int64()),
                lists(sections, np.array(counts, np.int64)),
            ],
            ["id", "n_tokens", "sections"],
        )


def token_sections(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    offsets_col: str | None = None,
    ranks: str = RANKS,
    pattern: str = PATTERN,
    rule: str = "first",
) -> DataFrame:
    """``id``, ``n_tokens`` and ``sections`` (start, end, tokens, crossing) of every row.

    ``offsets_col`` names an array of character offsets where sections start; without
    one, or where it is null, sections are lines.
    """
    if rule not in ("first", "last", "most"):
        raise ValueError(f"no rule {rule!r}")
    spark = docs.sparkSession
    ship(spark)
    with open(ranks, "rb") as f:
        vocabulary = f.read(VOCABULARY_BYTES + 1)
    if len(vocabulary) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to broadcast")
    shared = spark.sparkContext.broadcast(vocabulary)
    none = F.lit(None) if offsets_col is None else F.col(offsets_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        none.cast("array<bigint>").alias("offsets"),
    )
    kind = "array<struct<start:bigint,end:bigint,tokens:bigint,crossing:bigint>>"
    schema = rows.select(
        "id", F.lit(0).cast("bigint").alias("n_tokens"), F.lit(None).cast(kind).alias("sections")
    ).schema
    return rows.mapInArrow(lambda batches: _count(batches, shared, pattern, rule), schema)


def by_section(counted: DataFrame) -> DataFrame:
    """One row per document and section."""
    return counted.select("id", "n_tokens", F.posexplode("sections").alias("section", "s")).select(
        F.col("id").alias("doc_id"),
        "section",
        F.col("s.start").alias("start_char"),
        F.col("s.end").alias("end_char"),
        F.col("s.tokens").alias("section_tokens"),
        F.col("s.crossing").alias("crossing_tokens"),
        F.col("n_tokens").alias("doc_tokens"),
    )
