"""The mix against plain Python: targets, exact budgets, whole epochs, order by hash."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from rillflow.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key_of(doc_id, text):
    return hashlib.md5(f"mix:{'' if doc_id is None else doc_id}:{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()


def brute(rows, weights=(5, 2, 1), share=1.5):
    """taken by (source, doc_id, size) for rows (doc_id, text, source), targets by source."""
    size = lambda t: len(WORD.findall(t or ""))
    sources = sorted({r[2] for r in rows if r[2] is not None}) + ([None] if any(r[2] is None for r in rows) else [])
    total = {s: sum(size(r[1]) for r in rows if r[2] == s) for s in sources}
    w = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    budget, stopped = share * sum(total.values()), set()
    while True:
        free = [s for s in sources if s not in stopped]
        if not free:
            break
        level = (budget - sum(2 * total[s] for s in stopped)) / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > 2 * total[s]}
        if not over:
            break
        stopped |= over
    target = {s: 2.0 * total[s] if s in stopped else level * w[s] for s in sources}
    out = []
    for s in sources:
        own = sorted(((key_of(r[0], r[1]),
                       -1 if r[0] is None else r[0], size(r[1])) for r in rows if r[2] == s))
        quota = int(target[s])
        epochs, rest = divmod(quota, total[s]) if total[s] else (0, 0)
        for k, d, n in own:
            part = max(0, min(n, rest))
            rest -= n
            out.append((None if d == -1 else d, n, total[s], round(target[s], 6), epochs * n + part))
    return sorted(out, key=repr)


ROWS = [(i, "w " * (i % 7), f"s{i % 4}") for i in range(60)] + \
    [(None, "a b c", "s1"), (None, None, None), (5, "x y", None), (5, "x y", None), (5, "x y z", None)] + \
    [(100 + i, "hot " * 40, "s2") for i in range(50)] + [(200, "one", "tiny"), (201, None, "empty"), (202, "", "")]


def collect(df):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=repr)


@pytest.mark.parametrize("digits", [1, 4])
def test_equals_brute_force(make_docs, monkeypatch, digits):
    monkeypatch.setattr(M, "RANGE_DIGITS", digits)  # few ranges: many rows in the last one
    docs = make_docs([(d, t, "en", s) for d, t, s in ROWS], ["7 AS size", "'x' AS taken"])
    assert collect(M.mix(M.with_size_and_key(docs))) == brute(ROWS)


@pytest.mark.parametrize("parts", [1, 6])
def test_equal_rows_without_an_id(make_docs, parts):
    """A third and more of a source is one row, and its budget ends among its copies."""
    rows = [(None, "same words here", "a")] * 70 + [(i, "w " * (i % 5), "a") for i in range(60)] + \
        [(7, "one two", "b")] * 40 + [(None, "z", "c")] * 9
    ends = 0
    for share in (0.3, 0.7, 1.5):
        docs = make_docs([(d, t, "en", s) for d, t, s in rows]).repartition(parts)
        assert collect(M.mix(M.with_size_and_key(docs), share=share)) == brute(rows, share=share)
        ends += any(0 < r[4] % max(r[1], 1) for r in brute(rows, share=share))
    assert ends


def test_budgets_are_exact_and_no_document_exceeds_two_epochs(spark):
    out = M.op9_mixing(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source")
    by = out.join(docs, "doc_id").groupBy("source").agg(
        F.sum("taken").alias("t"), F.first("target").alias("g"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"))
    for r in by.collect():
        assert r.t == int(r.g) and r.over <= 0


def test_stage_takes_the_words_of_the_plan(spark, make_docs):
    docs = make_docs([(d, t, "en", s) for d, t, s in ROWS])
    got = M.mix_stage(spark, docs, "")
    assert got.columns == docs.columns
    words = got.select("source", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n"))
    assert words.filter("n = 0").count() == 0
    have = {r.source: r.n for r in words.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    plan = {}
    for d, n, total, target, taken in brute(ROWS):
        plan[(total, target)] = plan.get((total, target), 0) + taken
    assert sorted(have.values()) == sorted(v for v in plan.values() if v)


def test_empty_table(make_docs, spark):
    docs = make_docs(ROWS[:1]).filter("false")
    assert M.mix(M.with_size_and_key(docs)).count() == 0
    assert M.mix_stage(spark, docs, "").count() == 0
