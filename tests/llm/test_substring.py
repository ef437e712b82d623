"""Substring dedup against plain Python over all windows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillflow.llm import substring as S
from rillflow.llm.arrowtext import digests, distinct_spans, joined, slices, split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length=13):
    words = [WORD.findall(t or "") for _, t in rows]
    ids = [float("inf") if d is None else d for d, _ in rows]
    least = {}
    for d, w in zip(ids, words):
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            least[k] = min(d, least.get(k, d))
    out = []
    for (raw, text), d, w in zip(rows, ids, words):
        gone = set()
        for i in range(len(w) - length + 1):
            if least[tuple(w[i:i + length])] < d:
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((raw, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if gone else text))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in df.collect()), key=repr)


def passages(seed=1, n=80):
    """Documents with shared passages of 5 to 60 words, repeats inside a document, few words."""
    r = random.Random(seed)
    shared = [[f"s{k}w{r.randrange(30)}é" for _ in range(r.choice([5, 12, 13, 14, 25, 60]))] for k in range(12)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "x " * 200), (904, "x " * 12), (905, "x " * 13), (None, "x " * 50),
            (None, " ".join(shared[3] * 2)), (906, "\t".join(shared[3])), (906, " ".join(shared[5]))]
    for i in range(n):
        words = []
        for _ in range(r.randrange(1, 6)):
            words += [f"u{r.randrange(10**6)}" for _ in range(r.randrange(30))]
            words += r.choice(shared) if r.random() < 0.6 else [r.choice("ab") for _ in range(r.randrange(20))]
        rows.append((i, r.choice([" ", "\n", "  "]).join(words)))
    rows += [(1000 + i, rows[20][1]) for i in range(5)] + [rows[20]]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("base,parts,room", [(7, 4, 4 << 20), (13, 3, 3000), (2, 2, 3000)])
def test_equals_brute_force(make_docs, monkeypatch, base, parts, room):
    monkeypatch.setattr(S, "slices", lambda b: slices(b, most=room))  # small room: many chunks
    rows = passages(base)
    docs = make_docs(rows, ["1 AS n_words", "'x' AS chunk", "2 AS level"]).repartition(parts)
    out = S.dedup_substrings(docs, base=base)
    assert {"lang", "source", "chunk", "level"} <= set(out.columns)
    assert got(out) == brute(rows)


def test_other_lengths(make_docs):
    rows = passages(8, 40)
    for length in (1, 2, 5, 30):
        assert got(S.dedup_substrings(make_docs(rows), length=length)) == brute(rows, length)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in S.op5_substring_dedup(spark, sf).collect()), key=repr)
    want = brute(rows)
    assert out == [w[:4] for w in want]
    assert sum(w[2] for w in want) > 0


def test_stage_and_empty_table(spark, make_docs):
    rows = passages(3, 20)
    docs = make_docs(rows, ["5 AS n_removed"])
    out = S.substring_stage(spark, docs, "")
    assert out.columns == docs.columns and out.filter("n_removed <> 5").count() == 0
    assert sorted((r.text for r in out.collect()), key=repr) == sorted((w[4] for w in brute(rows)), key=repr)
    assert out.filter("length(text) IS DISTINCT FROM n_chars").count() == 0
    assert S.substring_stage(spark, docs.filter("false"), "").count() == 0
    short = make_docs([(1, "a b"), (2, "a b")])  # no window at all
    assert S.dedup_substrings(short).agg(F.sum("n_removed")).first()[0] == 0


def test_levels():
    assert S.levels(13, 7) == [7, 13] and S.levels(13, 13) == [13] and S.levels(50, 7) == [7, 13, 25, 50]
    assert S.levels(1, 7) == [1]


def test_words_of_arrow_arrays():
    texts = ["a  b\tc", None, "", " é漢 x ", "end", "\x0b\x0c\r\n", "q\x1cr\x85s\xa0t"]
    arr = pa.array(["skip me", *texts]).slice(1)
    w = split_words(arr)
    out = [[bytes(w.buf[w.starts[i]:w.ends[i]]).decode() for i in range(a, b)] for a, b in zip(w.first, w.first[1:])]
    assert out == [WORD.findall(t or "") for t in texts]
    buf, at = joined(w)
    assert buf.tobytes().decode() == "".join(x + " " for ws in out for x in ws)
    keep = np.array([i % 2 == 0 for i in range(len(w.starts))])
    assert joined(w, keep)[0].tobytes().decode().split(" ")[:-1] == [x for ws in out for x in ws][::2]
    flat = [x for ws in out for x in ws]
    values, of = distinct_spans(w.buf, w.starts, w.ends)
    assert [values[i].as_py().decode() for i in of] == flat and len(values) == len(set(flat))
    high, low = digests(values)
    assert len({*high.tolist(), *low.tolist()}) == 2 * len(set(flat))


def test_words_that_differ_in_every_second_letter_only(make_docs):
    """A string of 1,024 letters and its complement have one polynomial hash modulo 2^64."""
    thue = "a"
    for _ in range(10):
        thue += thue.translate(str.maketrans("ab", "ba"))
    other = thue.translate(str.maketrans("ab", "ba"))
    words = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join([*words, thue])), (2, " ".join([*words, other])), (3, " ".join([*words, other]))]
    assert got(S.dedup_substrings(make_docs(rows))) == brute(rows)
    assert sum(b[2] for b in brute(rows)) == 13
