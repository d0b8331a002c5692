"""Progressive refinement against a dictionary."""

import hashlib

import pytest

from shelflife.llm import exact

LONG = "long " * 60_000
DOCS = [
    (1, "same"), (2, "same"), (3, "Same"), (4, None), (5, ""), (6, None), (7, LONG + "a"), (8, LONG + "b"),
    (9, LONG + "a"), (10, "p" * 64 + "x"), (11, "p" * 64 + "y"), (12, "p" * 64 + "x"), (13, "été"), (14, "été"),
    (15, "alone"), (1, "same"), (1, "other"), (None, "same"), (None, "null id"), (None, "null id"), (16, " "), (17, "\n"),
]


def frame(spark, docs=DOCS):
    rows = [(i, t, 7, "k", None) for i, t in docs]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, length int, keep_id string, hash string"
    )


def by_hand(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in docs:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hash_all", [True, False])
@pytest.mark.parametrize("broadcast_keys", [0, 500_000])
def test_odd_documents(spark, hash_all, broadcast_keys):
    groups = exact.exact_groups(frame(spark), hash_all=hash_all, broadcast_keys=broadcast_keys)
    rows = [(r.id, r.keep_id, r.group_size, r.kept, r.hash) for r in groups.collect()]
    want = by_hand(DOCS)
    if hash_all or not broadcast_keys:
        assert sorted(rows, key=str) == want
    else:  # texts that no other can equal are not hashed
        assert sorted((r[:4] for r in rows), key=str) == sorted((w[:4] for w in want), key=str)
        assert all(r[4] or r[2] == 1 for r in rows) and any(r[4] is None for r in rows)


def test_one_row_of_each_text_stays(spark):
    kept = exact.exact_deduped(frame(spark))
    assert kept.columns == frame(spark).columns
    rows = [(r.doc_id, r.text or "") for r in kept.collect()]
    want = {(w[1], t or "") for (_, t) in DOCS for w in by_hand([d for d in DOCS if (d[1] or "") == (t or "")])}
    assert len(rows) == len(set(rows)) and set(rows) == want


@pytest.mark.parametrize("broadcast_keys", [0, 500_000])
def test_only_survivors_are_hashed_and_moved(spark, monkeypatch, broadcast_keys):
    staged = {}

    def note(rows, folder):
        staged[folder.rsplit("/", 1)[1]] = found = write(rows, folder)
        return found

    write = exact.stage
    monkeypatch.setattr(exact, "stage", note)
    kept = exact.exact_deduped(frame(spark), broadcast_keys=broadcast_keys)
    assert "hash" not in staged["measured"].columns
    texts = [t or "" for _, t in DOCS]
    shared = sum([(len(x.encode()), x[:64]) for x in texts].count((len(t.encode()), t[:64])) > 1 for t in texts)
    assert staged["full"].where("hash is not null").count() == (shared if broadcast_keys else len(DOCS))
    rows = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert rows == sorted((str(r.doc_id), r.text or "") for r in exact.exact_deduped(frame(spark)).collect())
    assert len(rows) == len(set(texts))


def test_no_python_runs(spark):
    groups = exact.exact_groups(frame(spark))
    assert "Python" not in groups._jdf.queryExecution().toString()
    assert exact.exact_groups(frame(spark).limit(0)).count() == 0
    assert exact.exact_deduped(frame(spark).limit(0)).count() == 0
