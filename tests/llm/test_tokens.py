"""Attribution against a token-by-token count, totals against another library."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelflife.llm import tokens
from shelflife.llm.queries import QUERIES

OTHER = "/opt/tokenizers/byte_bpe_50k.json"


def by_hand(text, rule, offsets=None):
    """(start, end, tokens) of each section, one token and one byte at a time."""
    encode, sizes = tokens.encoder(open(tokens.RANKS, "rb").read(), tokens.PATTERN)
    if offsets is None:
        cuts = {i + 1 for i, c in enumerate(text) if c == "\n"}
    else:
        cuts = {x for x in offsets if x is not None and x > 0}
    cuts = sorted({0, *(c for c in cuts if c < len(text))}) + [len(text)]
    section_of_byte = []
    for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        section_of_byte += [s] * len(text[a:b].encode())
    counts, at = [0] * (len(cuts) - 1), 0
    for token in encode.encode_ordinary(text):
        own = section_of_byte[at : at + int(sizes[token])]
        at += int(sizes[token])
        pick = {"first": own[0], "last": own[-1], "most": max(sorted(set(own)), key=own.count)}
        counts[pick[rule]] += 1
    return [(a, b, n) for a, b, n in zip(cuts, cuts[1:], counts, strict=False)]


TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "a\nb\n", "tail\n\n  x", " " * 50 + "\n" + " " * 50,
    "été \U0001f600\n\U0001f468‍\U0001f469 ok\r\n\r\nend", "<|endoftext|>\nx", "日本語\n日本語", "x" * 30000,
]


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_edge_texts(spark, rule):
    rng = random.Random(3)
    rows = []
    for i, t in enumerate(TEXTS):
        n = len(t or "")
        rows.append((2 * i, t, None))
        rows.append((2 * i + 1, t, [rng.randrange(-2, n + 3) for _ in range(6)] + [None]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, cuts array<int>")
    got = tokens.token_sections(docs, offsets_col="cuts", rule=rule).collect()
    assert len(got) == len(rows)
    for r in got:
        text, cuts = rows[r.id][1] or "", rows[r.id][2]
        want = by_hand(text, rule, cuts)
        assert [(s.start, s.end, s.tokens) for s in r.sections] == want
        assert sum(s.tokens for s in r.sections) == r.n_tokens
    assert tokens.token_sections(docs.limit(0)).count() == 0


def test_crossing_tokens():
    kept, crossing = tokens.attribute(np.array([2, 5, 9]), np.array([0, 3, 4, 9]), "most")
    assert kept.tolist() == [2, 0, 1] and crossing.tolist() == [1, 0, 0]


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet")[["doc_id", "text"]].collect())
    other = Tokenizer.from_file(OTHER)
    other.encode_special_tokens = True
    got = {}
    for r in QUERIES["op9_token_counts"](spark, sf_dir).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == set(docs)
    for doc, sections in got.items():
        text = docs[doc] or ""
        sections.sort(key=lambda r: r.section)
        assert [(r.start_char, r.end_char, r.section_tokens) for r in sections] == by_hand(text, "first")
        assert sections[0].doc_tokens == len(other.encode(text, add_special_tokens=False).ids)
