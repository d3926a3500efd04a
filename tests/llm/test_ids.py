"""Large ids beside null ids in one batch keep their values; many languages; plain Viterbi."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from loadshift.llm import common as C
from loadshift.llm import op3_quality, op7_jaccard, op9_quality, op10_langid, op13_simhash

TOP = (1 << 63) - 1
BIG = [TOP - 3 * k for k in range(6)] + [(1 << 53) + 1, -(1 << 63), 5]


def prose(seed, n=80):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 8))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, prose(k), ["en", "de"][k % 2], "s0", TOP - k) for k, i in enumerate(BIG)]
    rows += [(None, prose(99), "en", "s1", TOP), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return C.materialise(df.coalesce(1), "test_ids")


def ids(df):
    return sorted((r[0] for r in df.select("doc_id").collect()), key=str)


WANT = sorted([*BIG, None, None], key=str)


def test_operators_keep_ids(spark, docs):
    judged = op3_quality.judge(docs, keep_columns=("doc_id", "n_chars"))
    assert ids(judged) == WANT
    assert {r.doc_id: r.n_chars for r in judged.collect() if r.doc_id} == {i: TOP - k for k, i in enumerate(BIG)}
    joined = op7_jaccard.join(docs)
    assert ids(joined) == WANT and {r.doc_id: r.component_id for r in joined.collect() if r.doc_id} == {i: i for i in BIG}
    assert ids(op7_jaccard.deduplicate(docs)) == WANT
    labels = spark.createDataFrame([(i, k % 2, 0) for k, i in enumerate(BIG)], "doc_id long, quality int, toxic int")
    assert ids(op9_quality.classify(docs, labels)) == WANT
    known = op10_langid.fit(docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text"))
    assert ids(op10_langid.predict(docs, known)) == WANT
    assert ids(op13_simhash.join(docs)) == WANT


def test_stages_keep_ids(spark, docs):
    step = docs
    for name, stage in P.STAGES[:-1]:
        step = C.materialise(stage(spark, step, "/root/testdata/sf0.001"), f"ids_{name}")
        found = {r.doc_id: r.text for r in step.collect() if r.doc_id is not None}
        assert found == {i: prose(k) for k, i in enumerate(BIG)}, name
        assert step.columns == docs.columns


def test_the_row_of_a_repeated_id_is_stated(spark):
    rows = [(7, "b " + prose(1), "x"), (7, "a " + prose(2), "y"), (7, "a " + prose(2), "b"), (8, prose(3), "z")]
    for part in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string, other string").repartition(part)
        kept = {(r.doc_id, r.text[:1], r.other) for r in op7_jaccard.deduplicate(df).collect()}
        assert kept == {(7, "a", "b"), (8, prose(3)[:1], "z")}


def plain_viterbi(scores, penalty):
    best, back = [list(scores[0])], []
    for row in scores[1:]:
        v = best[-1]
        top = max(range(len(v)), key=lambda k: (v[k], -k))
        came = [top if v[k] < v[top] - penalty else k for k in range(len(v))]
        best.append([row[k] + max(v[k], v[top] - penalty) for k in range(len(v))])
        back.append(came)
    k = max(range(len(best[-1])), key=lambda j: (best[-1][j], -j))
    out = [k]
    for came in reversed(back):
        k = came[k]
        out.append(k)
    return out[::-1]


@pytest.mark.parametrize("n_labels", [1, 2, 5, 300])
def test_viterbi_equals_a_plain_one(n_labels):
    r = np.random.default_rng(n_labels)
    sizes = np.array([0, 1, 7, 30, 2, 0, 30, 11])
    scores = (r.integers(-12, 0, (sizes.sum(), n_labels)) * 1.5).astype(np.float64)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    got = op10_langid.viterbi(scores, begin, sizes, penalty=4.0)
    for a, n in zip(begin, sizes, strict=True):
        if n:
            assert got[a:a + n].tolist() == plain_viterbi(scores[a:a + n].tolist(), 4.0)


def test_three_hundred_languages(spark):
    """Every language of disjoint words is found, also those above the 127th."""
    alphabet = "abcdefghijklmnopqrstuvwxyz"

    def text(k, n, seed):
        r = random.Random(seed)
        own = [alphabet[k // 26 % 26] + alphabet[k % 26] * 2 + alphabet[(k * 7 + j) % 26] + alphabet[k // 26 % 26] for j in range(4)]
        return " ".join(r.choice(own) for _ in range(n))

    names = [f"l{k:03d}" for k in range(300)]
    train = spark.createDataFrame([(n, text(k, 60, k)) for k, n in enumerate(names)], "lang string, text string")
    model = op10_langid.fit(train)
    test = spark.createDataFrame([(k, text(k, 25, 1000 + k)) for k in range(300)], "doc_id long, text string")
    out = {r.doc_id: r.lang_pred for r in op10_langid.predict(test, model).collect()}
    assert sum(out[k] == n for k, n in enumerate(names)) >= 297


def test_chunks_do_not_change_predictions(spark, monkeypatch):
    texts = [prose(k, 40 + k) for k in range(30)] + ["", "x", "Ελλάδα και " + prose(5)]
    train = spark.createDataFrame([(["a", "b", "c"][k % 3], prose(k % 3, 60 + k)) for k in range(12)], "lang string, text string")
    model, reader = op10_langid.fit(train), op10_langid.Reader()
    whole = op10_langid.predict_texts(texts, model, reader)
    assert [op10_langid.predict_texts([t], model, reader)[0] for t in texts] == whole
