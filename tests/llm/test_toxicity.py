"""Features and chain by hand on small data, held-out figures on the test table."""

import zlib

import numpy as np

from shelflife.llm import toxicity
from shelflife.llm.queries import QUERIES

CATEGORIES = {"rude": "rude = 1", "toxic": "toxic = 1"}


def features(texts):
    data = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    found = toxicity.once(*toxicity.features(np.frombuffer(b"".join(data), np.uint8), bounds))
    return [sorted(found[1][found[0] == i].tolist()) for i in range(len(texts))]


def test_features_do_not_depend_on_other_texts():
    texts = ["Some words, été", "", "12 !!", "SOME words some", "x" * 5000]
    assert features(texts) == [features([t])[0] for t in texts]
    assert all(len(f) >= 6 for f in features(texts))  # the shape, at least


def test_later_models_see_out_of_fold_odds():
    """A category that repeats the one before it is learned from the chain."""
    rng = np.random.default_rng(4)
    n = 600
    first = rng.integers(0, 2, n)
    numbers = np.where(first == 1, 100, 200)  # one telling feature
    noise = rng.integers(1000, 1040, n)
    texts = np.repeat(np.arange(n), 2)
    labels = np.stack([first, first], axis=1).astype(float)
    flat = np.stack([numbers, noise], axis=1).ravel().astype(np.uint64)
    chain = toxicity.fit_chain(texts, flat, labels, np.arange(n) % 3, np.ones(n))
    assert chain[1].chained[0] > 0
    p = toxicity.apply_chain(chain, np.array([0, 1]), np.array([100, 200], np.uint64), 3)
    assert p[0].min() > 0.9 and p[1].max() < 0.1


def frames(spark):
    rows = []
    for i in range(300):
        bad = i % 5 == 0
        rows.append((i, f"word{i % 17} plain talk {'youfool' if bad else 'friend'}{i % 3} number", int(bad)))
    docs = [(i, t, 0.5) for i, t, _ in rows] + [
        (900, None, 0.1), (901, "", 0.1), (902, "plain talk " * 9000 + "youfool1", 0.1),
        (902, "plain talk", 0.1), (None, "plain talk friend1", None), (0, rows[0][1], 0.5),
    ]
    labels = [(i, b, b) for i, _, b in rows] + [(3, None, 0), (0, 1, 1), (5000, 1, 1), (None, 1, 1)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, p_toxic double"),
        spark.createDataFrame(labels, "doc_id bigint, rude int, toxic int"),
        {i for i, _, b in rows if b},
    )


def test_edge_rows(spark):
    docs, labels, bad = frames(spark)
    chain = toxicity.train(docs, labels, CATEGORIES)
    got = toxicity.score(docs, chain, CATEGORIES).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.p_toxic <= 1 and 0 <= r.p_rude <= 1
        if r.id is not None and r.id < 900:
            assert (r.p_toxic >= 0.5) == (r.id in bad)
    assert max(r.p_toxic for r in got if r.id == 902) >= 0.5  # one word at the very end
    assert toxicity.score(docs.limit(0), chain, CATEGORIES).count() == 0


def test_nothing_to_learn_from(spark):
    docs, labels, _ = frames(spark)
    chain = toxicity.train(docs, labels.limit(0), CATEGORIES)
    assert toxicity.score(docs, chain, CATEGORIES).where("p_toxic > 0.01").count() == 0
    chain = toxicity.train(docs, labels.where("toxic = 0"), CATEGORIES)
    assert toxicity.score(docs, chain, CATEGORIES).where("p_toxic > 0.01").count() == 0


def test_held_out_figures(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = dict(spark.read.parquet(f"{sf_dir}/labels.parquet")[["doc_id", "toxic"]].collect())
    hit = wrong = total = clean = 0
    for r in QUERIES["op8_toxicity"](spark, sf_dir).collect():
        if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 3 == 1:
            total += labels[r.doc_id]
            clean += 1 - labels[r.doc_id]
            hit += r.toxic and labels[r.doc_id] == 1
            wrong += r.toxic and labels[r.doc_id] == 0
    assert hit / total > 0.7 and wrong / clean < 0.03
