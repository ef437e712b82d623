"""Toxicity: held-out accuracy, features by brute force, odd rows."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rillflow.llm import toxicity as X
from rillflow.llm.letters import gram_slots

TEXTS = ["Idiot the idiot, THE end", None, "", "12 3", "é é漢 x", "a " * 300]


def brute(text):
    words = {w.lower() for w in re.findall(r"[^\W\d_]+", text or "")}
    out = Counter()
    for w in words:
        chars = np.array([0, *map(ord, w), 0], np.uint32)
        for k, n in enumerate(X.ORDERS):
            for s in gram_slots(chars, n, X.BITS):
                out[(k << X.BITS) + int(s)] += 1 / np.sqrt(len(words))
    return out


def test_features_equal_brute_force():
    text, slot, value = X.features(pa.array(TEXTS))
    got = [{} for _ in TEXTS]
    for t, s, v in zip(text, slot, value):
        assert int(s) not in got[t]
        got[t][int(s)] = v
    for g, t in zip(got, TEXTS):
        assert g == pytest.approx(dict(brute(t)))


def test_scores_are_linear_in_the_features():
    w = np.random.default_rng(0).normal(0, 1, len(X.ORDERS) << X.BITS).astype(np.float32)
    for s, t in zip(X.scores(pa.array(TEXTS), w, 0.3), TEXTS):
        z = 0.3 + sum(w[k] * v for k, v in brute(t).items())
        assert s == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-4)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = X.op10_toxicity(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    got = out.join(labels, "doc_id").filter("held_out").toPandas()
    toxic, clean = got[got["toxic"] == 1], got[got["toxic"] == 0]
    assert toxic["predicted"].mean() > 0.88 and clean["predicted"].mean() < 0.01
    assert ((got["score"] >= 0.7) == (got["predicted"] == 1)).all() and got["score"].between(0, 1).all()


def test_odd_rows(spark, make_docs):
    rows = [(i, "you are an idiot and a moron indeed" if i % 3 == 0 else f"a fine day w{chr(97 + i % 20)}x to walk") for i in range(90)]
    docs = make_docs([*rows, (0, rows[0][1]), (None, "idiot"), (900, None), (901, ""), (902, "idiot " * 60000)], ["1 AS score", "2 AS toxic"])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(0, 0), (1, None), (None, 1), (5000, 1)], "doc_id bigint, toxic int")
    model = X.train(docs, labels)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.score >= 0.7) for r in X.score_documents(docs, *model).collect())
    assert len(got) == 95 and (902, True) in got and (-1, True) in got and (900, False) in got and (901, False) in got
    assert sum(yes for d, yes in got if 0 <= d < 90) == 31
    none = X.train(docs, labels.filter("false"))
    assert all(r.score < 0.01 for r in X.score_documents(docs, *none).collect())
    one = X.train(docs, labels.filter("toxic = 1"))
    assert all(r.score > 0.99 for r in X.score_documents(docs, *one).collect())
    assert X.score_documents(docs.filter("false"), *model).count() == 0
    bounded = X.train(docs, labels, fit_docs=40)
    assert np.isfinite(bounded[0]).all()


def test_sample_is_bounded_by_bytes(spark):
    rows = [(i, "toxic words here " * 40 if i % 2 else "kind words there " * 40) for i in range(30)] + [(99, None)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert X._within(texts, 1 << 20).count() == 31
    some = X._within(texts, 5_000)
    assert 1 < some.count() < 31 and some.selectExpr("sum(octet_length(text))").first()[0] <= 5_000
    assert X._within(texts.filter("doc_id = 3"), 10).count() == 1
    assert X._within(texts.limit(0), 10).count() == 0
