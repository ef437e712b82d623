"""The quality rules against plain Python, and the label model on votes of known accuracy."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rillflow.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            dup, len(inside), failed)


def texts():
    r = random.Random(3)
    out = [None, "", " \n\t ", "one", "a b\na b\n\n \na b", "x " * 5000, "é ñ 漢字 😀 " * 30,
           "w1 w2 w3 w4 w5 w6 w7 w8 " * 2, "a\x0bb\x0cc\rd e f"]
    for n in (7, 8, 9, 16, 17, 40, 300, 3000):
        out.append(" ".join(r.choice("abc") for _ in range(n)))
        out.append("\n".join(" ".join(f"w{r.randrange(50)}" for _ in range(r.randrange(9))) for _ in range(n // 4)))
    phrase = " ".join(f"p{i}" for i in range(11))
    out.append(" ".join(f"u{i}" for i in range(50)) + " " + phrase + " mid " + phrase + " %%% ### end")
    return out


def test_counts_equal_brute_force(make_docs):
    rows = list(enumerate(texts()))
    got = Q.with_counts(make_docs(rows + rows[-1:])).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        want = brute(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id


def test_whole_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op1_quality_rules(spark, sf).collect()
    assert len(got) == len(text)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == brute(text[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_kept_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    n = Q.op1_quality_rules(spark, sf).join(labels, "doc_id").groupBy("quality", "kept").count()
    n = {(r.quality, r.kept): r["count"] for r in n.collect()}
    good = n.get((1, True), 0) / (n.get((1, True), 0) + n.get((1, False), 0))
    bad = n.get((0, False), 0) / (n.get((0, False), 0) + n.get((0, True), 0))
    assert good > 0.95 and bad > 0.9, n


def test_em_finds_the_chances():
    r = random.Random(1)
    good, bad = (0.02, 0.18, 0.8), (0.8, 0.15, 0.05)  # of a bad vote, none, a good vote
    votes, kinds = Counter(), list(Q.RULE_DEFECT.values())
    for _ in range(20000):
        kind = r.choices([None, "noise", "shouting", "structure"], (0.7, 0.1, 0.15, 0.05))[0]
        votes[tuple(r.choices((-1, 0, 1), bad if k == kind else good)[0] for k in kinds)] += 1
    model = Q.fit_label_model(sorted(votes.items()), rounds=100)
    assert [round(m[0], 1) for m in model[:3]] == [0.7, 0.1, 0.1] or abs(model[0][0] - 0.7) < 0.03
    for b in model[0][1]:
        assert abs(b - 0.02 / 0.82) < 0.03
    for b, k in zip(model[1][1], kinds):
        assert abs(b - (0.8 / 0.85 if k == "noise" else 0.02 / 0.82)) < 0.05, k


def test_a_lone_bad_vote_is_outvoted_and_rare_defects_are_found():
    ok = (1,) * 9
    patterns = [(ok, 9000), ((1, 1, -1, -1, -1, -1, 1, 1, 1), 400), ((-1, -1, *ok[2:]), 300),
                ((-1, *ok[1:]), 200)]
    model = Q.fit_label_model(patterns)
    assert [Q.class_chances(v, model)[0] > 0.5 for v, _ in patterns] == [True, False, False, True]


def test_posterior_is_the_models(make_docs):
    docs = make_docs(list(enumerate(texts())))
    c = Q.with_counts(docs)
    model = Q.fit_label_model(Q.vote_patterns(c))
    votes = {r[0]: tuple(r[1:]) for r in c.select("doc_id", *Q.rules().values()).collect()}
    for r in Q.judge(c, model).collect():
        p = Q.class_chances(votes[r.doc_id], model)[0]
        assert abs(r.posterior - p) < 1e-9 and r.kept == (not r.base_failed and p >= 0.5)


@pytest.mark.parametrize("where", ["false", "true"])
def test_empty_table_and_clashing_columns(spark, make_docs, where):
    docs = make_docs([(1, "a b c"), (None, None)], ["'x' AS kept", "1 AS n_words", "2 AS posterior"])
    out = Q.quality_stage(spark, docs.filter(where), "")
    assert out.columns == docs.columns and out.count() == 0
    assert Q.vote_patterns(Q.with_counts(docs.filter("false"))) == []
    assert Q.fit_label_model([])[0][0] == Q.START_SHARE
    assert Q.with_counts(docs).filter(F.col("base_failed")).count() == 2
