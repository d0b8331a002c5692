"""Counts and verdicts of line-first cleaning, against one text at a time in plain Python."""

import random
import re

import pytest

from shelflife.llm import lines, shared

PROSE = "The quick brown fox went over the hill and did not come back before it was dark. "
DOCS = [
    None, "", " \t\n\x0b", "one", "one two three", "a a a a a", "a b c a b c", "x\n\nx\n \nx\r\nx",
    PROSE * 4, PROSE + "\n" + " ".join(f"w{i}" for i in range(80)) + ".", "Home | News | Contact | Help",
    "\n".join(f"Item a{i} b{i} c{i} d{i} went to{i} e{i} well." for i in range(30)),
    "\n".join(f"Item a{i} b{i} c{i} d{i} went to{i} e{i} well." for i in range(8)) + "\nHome | News | a\n" * 40,
    "\n".join(f"Link {i} | other {i} | third {i}" for i in range(40)),
    "\n".join(f"Word{i}!! thing{i}!! again{i}!!" for i in range(40)),
    "\n".join(f"é{i}### ü{i}*** ß{i}$$$ and some more." for i in range(20)),
    "\n".join(f"no end to this line number {i}" for i in range(20)),
    " ".join(f"w{i}" for i in range(60)) + ". cut off he",
    "Licensed under the Apache License, Version 2.0.\n" + " ".join(f"w{i}" for i in range(60)) + " cookie.",
    "MENU\nlog in\nSkip to content\n“Quoted.”\nHome, sweet home, is what they say.\n" * 12,
    "日本語の文。\n" * 60, "日本 語 です。 " * 70, "a\x85b c d e " * 30, "\x00 nul \x00",
    "very " * 300_000 + "long.", " ".join(f"w{i}" for i in range(200_000)) + ".",
]


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    inside = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(3)}
    seen, again, lost, failing, n_lines = set(), 0, 0, [0, 0, 0], 0
    kept = []
    for line in text.split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if not own:
            kept.append(line)
            continue
        n_lines += 1
        again += line in seen
        seen.add(line)
        separators = len(re.findall(lines.SEPARATORS, line))
        fails = [
            not re.search(lines.SENTENCE_END, line) or 10 * len(re.findall(lines.MARKS, line)) > 3 * len(own),
            (separators >= 2 and len(own) <= 4 * (separators + 1)) or bool(re.search(lines.MENU, line)),
            len(own) <= 30 and bool(re.search(lines.NOTICE, line)),
        ]
        failing = [a + b for a, b in zip(failing, fails, strict=True)]
        if any(fails):
            lost += sum(map(len, own))
        else:
            kept.append(line)
    chars = sum(map(len, words))
    base = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    counts = (len(words), chars, symbols, again, len(inside), n_lines, *failing, lost)
    return (*counts, base, not base and 100 * lost <= 50 * chars, "\n".join(kept))


def frame(spark, texts):
    rows = [(i // 2, t, 5, "x", True) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, id string, kept boolean")


def check(spark, texts):
    rows = lines.judged(frame(spark, texts), with_text=True).collect()
    got = sorted((r.id, *[r[c] for c in lines.COUNTS], r.base_failed, r.kept, r.cleaned) for r in rows)
    assert got == sorted((i // 2, *by_hand(t)) for i, t in enumerate(texts))
    return got


def test_odd_texts(spark):
    got = check(spark, DOCS)
    assert {r[-2] for r in got} == {True, False} and {r[-3] for r in got} == {True, False}


@pytest.mark.parametrize("part_bytes", [1, 300])
def test_random_texts_in_small_parts(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(shared.text_parts, "__defaults__", (part_bytes,))
    rng = random.Random(13)
    pieces = ["a", "b", "cc", "é.", "Home", " ", "\n", "  ", "|", "::", "!!", "cookie", ".", "»", "\t", "#", "x. y"]
    check(spark, ["".join(rng.choice(pieces) + " " * rng.randrange(2) for _ in range(rng.randrange(90))) for _ in range(60)])


def test_lines_that_fail_go(spark):
    text = "\n".join(f"Item a{i} b{i} c{i} d{i} went to{i} e{i} well." for i in range(9))
    rows = lines.cleaned(frame(spark, [text + "\nHome | News | Help\n\nAll rights reserved.\nEnd."])).collect()
    assert [r.cleaned for r in rows] == [text + "\n\nEnd."]


def test_empty_table_and_no_shuffle(spark):
    empty = frame(spark, ["x"]).limit(0)
    assert lines.judged(empty).count() == 0 and lines.cleaned(empty).count() == 0
    assert "Exchange" not in lines.judged(frame(spark, DOCS[:3]))._jdf.queryExecution().executedPlan().toString()
