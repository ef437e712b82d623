"""Language identification: held-out accuracy, the path search by brute force, mixed texts."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from rillflow.llm import language as L
from rillflow.llm.letters import distinct, letter_words


def best_path(scores, switch):
    n, k = scores.shape
    return max(sum(scores[t, p[t]] for t in range(n)) - switch * sum(a != b for a, b in zip(p, p[1:]))
               for p in itertools.product(range(k), repeat=n))


def test_labels_are_a_best_path():
    r = np.random.default_rng(1)
    lens = [int(x) for x in r.integers(0, 8, 150)]
    first = np.concatenate([[0], np.cumsum(lens)])
    scores = r.normal(0, 2, (first[-1], 3))
    for switch in (0.5, 2.0, 5.0):
        label = L.label_words(scores, first, switch)
        for a, b in zip(first, first[1:]):
            if b > a:
                own, p = scores[a:b], label[a:b]
                value = own[np.arange(b - a), p].sum() - switch * (p[1:] != p[:-1]).sum()
                assert value == pytest.approx(best_path(own, switch))


def one_by_one(scores, switch):
    """The value of a best path, word by word."""
    best = scores[0].copy()
    for s in scores[1:]:
        best = np.maximum(best, best.max() - switch) + s
    return best.max()


def test_long_texts_in_blocks():
    r = np.random.default_rng(3)
    lens = [1, 63, 64, 65, 128, 129, 400, 1000, 0, 700] + [int(x) for x in r.integers(1, 300, 60)]
    first = np.concatenate([[0], np.cumsum(lens)])
    for noise in (0.3, 2.0):
        runs = np.repeat(r.normal(0, 1, (first[-1] // 20 + 1, 4)), 20, axis=0)[:first[-1]]
        scores = r.normal(0, noise, (first[-1], 4)) + runs
        for switch in (0.0, 1.0, 6.0, 30.0):
            label = L.label_words(scores, first, switch)
            for a, b in zip(first, first[1:]):
                if b > a:
                    own, p = scores[a:b], label[a:b]
                    value = own[np.arange(b - a), p].sum() - switch * (p[1:] != p[:-1]).sum()
                    assert value == pytest.approx(one_by_one(own, switch)), (b - a, noise, switch)


def test_words_and_scripts():
    w, off = letter_words(pa.array(["Ab1c", None, "", "Ünï 漢字 ж!", "ΣΑΣ"]))
    words = ["".join(map(chr, w.buf[a:b])) for a, b in zip(w.starts, w.ends)]
    assert words == ["ab", "c", "ünï", "漢字", "ж", "σασ"]
    assert w.first.tolist() == [0, 2, 2, 2, 5, 6] and off.tolist() == [0, 4, 4, 4, 13, 16]
    d = distinct(w, before=2)
    assert len(d.first) == 7
    assert len({int(x) for x in L.script_of(np.array([ord(c) for c in "aéẞ漢〇жσあア한ع"], np.uint32))}) == 7


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return L.learn(docs.filter(~L.held_out()))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = L.op7_language(spark, sf).join(docs, "doc_id").filter("held_out").toPandas()
    assert len(got) > 2000 and got["score"].between(0, 1).all()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.98


def test_mixed_text_gets_spans(spark, make_docs, model):
    part = {r.lang: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
            .filter("length(text) BETWEEN 600 AND 1500").orderBy("doc_id").collect()}
    text = part["en"] + "\n" + part["de"] + "\n" + part["en"]
    r = L.identify(make_docs([(1, text)]), model).first()
    assert r.lang_pred == "en" and 0 < r.score < 1
    assert [s.lang for s in r.spans] == ["en", "de", "en"]
    assert abs(r.spans[1].start - len(part["en"]) - 1) < 40


def test_odd_rows(make_docs, model):
    rows = [(1, None), (2, ""), (3, "12 ?! 34"), (None, "the and of"), (4, "the"), (4, "the"), (5, "the and " * 30000), (6, "漢字"), (7, "жук")]
    docs = make_docs(rows, ["1 AS score", "'x' AS lang_pred"])
    got = {(r.doc_id, r.lang_pred, r.score > 0, len(r.spans)) for r in L.identify(docs, model).collect()}
    assert {(1, "und", False, 0), (2, "und", False, 0), (3, "und", False, 0), (5, "en", True, 1)} <= got
    assert {r[1] for r in got if r[0] in (6, 7)} <= {*model.langs}
    assert L.identify(docs.filter("false"), model).count() == 0


def test_no_labels(make_docs):
    docs = make_docs([(1, "some words", None)])
    model = L.learn(docs)
    r = L.identify(docs, model).first()
    assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])


def test_scripts_narrow_the_candidates(make_docs):
    r = random.Random(1)
    words = lambda alphabet: " ".join("".join(r.choice(alphabet) for _ in range(5)) for _ in range(300))
    docs = make_docs([(1, words("abcdefg"), "xa"), (2, words("абвгдеж"), "xb")])
    model = L.learn(docs)
    got = {r.doc_id: r.lang_pred for r in L.identify(make_docs([(3, words("zyxwv")), (4, words("шщэюя"))]), model).collect()}
    assert got == {3: "xa", 4: "xb"}  # letters never seen, but a script that one language has


def test_counts_and_scores_are_exact(make_docs):
    r = random.Random(4)
    han = [chr(0x4E00 + i) for i in range(20000)]
    words = {"xa": [], "xb": ["abc", "bcd", "abc"], "xc": ["cab", "zz"]}
    words["xa"] = ["".join(r.choice(han) for _ in range(3)) for _ in range(12000)]
    docs = make_docs([(i, " ".join(w), x) for i, (x, w) in enumerate(words.items())])
    model = L.learn(docs)
    counts = {x: {} for x in words}
    for x, ws in words.items():
        for m in ("\0\0" + w + "\0" for w in ws):
            for n in (1, 2, 3):
                for i in range(len(m) - n + 1):
                    counts[x][m[i:i + n]] = counts[x].get(m[i:i + n], 0) + 1
    assert sum(len(g) == 1 for g in counts["xa"]) > 1 << L.BITS - 1 and sum(len(g) == 3 for g in counts["xa"]) > 1 << L.BITS
    code = lambda g: sum(ord(c) + 1 << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    got = {row.gram: list(row.n) for row in model.grams.collect()}
    assert got == {code(g): [counts[x].get(g, 0) for x in model.langs] for g in {g for c in counts.values() for g in c}}

    def likelihood(w, x):
        m, c, out = "\0\0" + w + "\0", counts[x], 0.0
        total = sum(n for g, n in c.items() if len(g) == 1)
        for i in range(2, len(m)):
            one = (c.get(m[i], 0) + 0.5) / (total + 0.5 * (1 << L.BITS))
            two = (c.get(m[i - 1:i + 1], 0) + 2 * one) / (c.get(m[i - 1], 0) + 2)
            out += np.log((c.get(m[i - 2:i + 1], 0) + 2 * two) / (c.get(m[i - 2:i], 0) + 2))
        return out

    asked = ["abc", "cabz", "q", *r.sample(words["xa"], 20), "漢字"]
    text = make_docs([(1, " ".join(asked))])
    rows = sorted((row.gram, list(row.score)) for row in model.triple_scores(L.distinct_triples(text)).collect())
    d = distinct(letter_words(pa.array([" ".join(asked)]))[0], before=2)
    scores = L.word_scores(d, np.array([g for g, _ in rows]), np.array([x for _, x in rows]), model.uses)
    for w, row in zip(asked, scores[d.of_word]):
        uses = ["xa"] if ord(w[0]) > 0x3400 else ["xb", "xc"]
        assert list(row) == pytest.approx([likelihood(w, x) - L.NO_SCRIPT * (x not in uses) for x in model.langs])
