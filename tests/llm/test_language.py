"""Posteriors against enumeration, blocks against one chain, held-out accuracy."""

import itertools
import zlib

import numpy as np

from shelflife.llm import language
from shelflife.llm.queries import QUERIES


def one_chain(evidence, transitions):
    """Word posteriors of one text by the textbook recursion."""
    emit, move = np.exp(evidence), np.exp(transitions)
    n, k = evidence.shape
    ahead, behind = np.zeros((n, k)), np.ones((n, k))
    now = np.full(k, 1 / k)
    for t in range(n):
        now = now @ move * emit[t]
        now /= now.sum()
        ahead[t] = now
    for t in range(n - 2, -1, -1):
        behind[t] = move @ (emit[t + 1] * behind[t + 1])
        behind[t] /= behind[t].sum()
    both = ahead * behind
    return both / both.sum(axis=1, keepdims=True)


def test_recursion_equals_enumeration():
    rng = np.random.default_rng(1)
    evidence, transitions = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    weight = np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=5):
        score = sum(evidence[t, c] for t, c in enumerate(path))
        score += sum(transitions[a, b] for a, b in zip(path, path[1:], strict=False))
        score += np.log(np.exp(transitions[:, path[0]]).sum())
        for t, c in enumerate(path):
            weight[t, c] += np.exp(score)
    assert np.allclose(one_chain(evidence, transitions), weight / weight.sum(axis=1, keepdims=True))


def test_blocks_equal_one_chain():
    rng = np.random.default_rng(2)
    lengths = [0, 1, 5, language.BLOCK, language.BLOCK + 1, 0, 3 * language.BLOCK, 777, 2]
    firsts = np.concatenate([[0], np.cumsum(lengths)])
    evidence = rng.normal(scale=3, size=(firsts[-1], 4))
    transitions = rng.normal(size=(4, 4))
    got = language.posteriors(evidence, firsts, transitions)
    for i, (a, b) in enumerate(zip(firsts, firsts[1:], strict=False)):
        want = one_chain(evidence[a:b], transitions).sum(axis=0) if b > a else np.zeros(4)
        assert np.allclose(got[i], want, atol=1e-3 * max(b - a, 1))


def test_words_do_not_depend_on_their_neighbours():
    def words(texts):
        data = [t.encode() for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
        return language.words_of(np.frombuffer(b"".join(data), np.uint8), bounds)

    a, b = words(["the Été", "x", "", "won't 12"]), words(["the", "ÉTÉ", "x", "won't"])
    assert np.array_equal(a.grams, b.grams) and np.array_equal(a.affixes, b.affixes)
    assert np.array_equal(a.slots, b.slots) and a.firsts.tolist() == [0, 2, 3, 3, 4]


ROWS = [(i, f"the cat and the dog number {i} sat on it", "en") for i in range(40)]
ROWS += [(100 + i, f"der hund und die katze nummer {i} saß darauf", "de") for i in range(40)]
ODD = [(500, None, "en"), (501, "", "de"), (502, "123 !? \U0001f600", "en"), (503, "the dog", None),
       (None, "und die katze", "de"), (505, "der hund " * 9000, None), (506, "Ω", None)]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in ROWS + ODD], "doc_id bigint, text string, lang string, id string, score double")
    got = language.predict(docs, language.train(docs)).collect()
    assert len(got) == len(ROWS) + len(ODD)
    by_id = {r.id: r for r in got}
    for i in (500, 501, 502):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[503].lang_pred == "en" and by_id[505].lang_pred == by_id[None].lang_pred == "de"
    assert by_id[506].lang_pred in ("de", "en") and not by_id[None].held_out
    for r in got:
        assert 0 <= r.score <= 1
        if r.id is not None:
            assert r.held_out == (zlib.crc32(str(r.id).encode()) % 3 == 1)


def test_prediction_reads_the_text_only(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string")
    model = language.train(docs)
    other = docs.selectExpr("doc_id", "text", "'zz' AS lang")
    assert language.predict(docs, model).collect() == language.predict(other, model).collect()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert language.train(docs) is None
    assert language.predict(docs, None).first().lang_pred == "und"
    model = language.train(spark.createDataFrame(ROWS, docs.schema))
    assert language.predict(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = dict(spark.read.parquet(f"{sf_dir}/documents.parquet")[["doc_id", "lang"]].collect())
    got = [r for r in QUERIES["op10_language"](spark, sf_dir).collect() if r.held_out]
    assert len(got) > 200
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) / len(got) > 0.98
