"""Packing: every id in exactly one piece, windows within their room, little padding."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillflow.llm import packing as P

PATH = P._tokenizer_path()


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_cut_texts_have_the_ids_of_whole_texts(plain):
    r = random.Random(1)
    signs = ["a", "b", " ", " ", "\n", " ", "é", ".", ",", "Z", "¿", "–", "　", "\r", "\x85", "'s", "1", "!", ".", "\0", "\t", "\x1c", "　", "\xa0"]
    texts = ["", " ", "  a  b", "a\n b\n\n  c ", "\0 \0a a\0.", "<|endoftext|> x", "don't  I'll 's 5 6  7"]
    texts += ["".join(r.choice(signs) for _ in range(r.randrange(40))) for _ in range(3000)]
    texts += [None, *(" ".join(f"Word{r.randrange(50)}{r.choice(['.', ',', '', '!?', '.\n'])}" for _ in range(30)) for _ in range(50))]
    ids, at = P.Encoder(PATH).encode(pa.array(texts))
    for text, a, b, want in zip(texts, at, at[1:], plain([t or "" for t in texts])):
        assert ids[a:b].tolist() == want, repr(text)


def test_parts_are_forgotten_in_bounds():
    e, whole = P.Encoder(PATH, kept=60 * 160), P.Encoder(PATH)
    for a in range(0, 300, 10):
        texts = pa.array([f"common word{i} and{i % 7}." + " " + "x" * 300 * (i % 2) for i in range(a, a + 10)])
        for x, y in zip(e.encode(texts), whole.encode(texts)):
            assert x.tolist() == y.tolist()
        assert len(e.place) == len(e.first) == len(e.count) <= 120 and len(e.ids) == e.count.sum()
        assert all(len(k) <= P.LONGEST_KEPT for k in e.place)


def test_parts_with_one_polynomial_hash(spark, make_docs, plain):
    """A string of 1,024 letters and its complement have one polynomial hash modulo 2^64."""
    thue = "a"
    for _ in range(10):
        thue += thue.translate(str.maketrans("ab", "ba"))
    texts = [f"x{thue}y", f"x{thue.translate(str.maketrans('ab', 'ba'))}y"]
    e = P.Encoder(PATH)
    for given in (texts, texts[::-1], texts[:1], texts[1:]):
        ids, at = e.encode(pa.array(given))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == plain(given)
    rows = list(enumerate(texts))
    check_pieces(rows, P.pack_documents(make_docs(rows).coalesce(1), PATH).collect(), plain)


@pytest.mark.parametrize("parts", [4, 200])
def test_short_texts_leave_little_room(spark, plain, parts):
    rows = [(i, f"short text number {i} with some words in it") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    assert check_pieces(rows, P.pack_documents(docs, PATH).collect(), plain) >= 0.98


def test_groups_of_the_second_pass(spark, make_docs, plain, monkeypatch):
    monkeypatch.setattr(P, "AGAIN", 2)
    rows = [(i if i % 9 else None, "word " * (i * 37 % 700)) for i in range(120)]
    pieces = P.pack_documents(make_docs(rows).repartition(40), PATH).collect()
    assert check_pieces(rows, pieces, plain) > 0.6
    assert len({p.sequence_id >> 36 for p in pieces}) > 3


def test_copies_are_cut_alike(make_docs, plain, monkeypatch):
    """Where a group ends, no piece is cut: the copies of a document have the same pieces."""
    monkeypatch.setattr(P, "GROUP", 3)
    rows = [(7, "word " * 605), (8, "word " * 2_700), (9, "few words")] * 30
    pieces = P.pack_documents(make_docs(rows).coalesce(1), PATH).collect()
    assert check_pieces(rows, pieces, plain) > 0.9
    spans = {d: sorted({(p.start, p.length) for p in pieces if p.doc_id == d}) for d in (7, 8, 9)}
    assert [len(s) for s in spans.values()] == [2, 3, 1]
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)


def test_what_is_left_at_the_end_is_packed_at_once():
    """Two windows and a little more need three, not two that overflow and one for the rest."""
    pieces = P.Pieces(2048, 0)
    for i in range(9):
        pieces.add(i, 0, bytes(4 * 460), 460)
    pieces.pack(all_of_it=True)
    assert len({p[5] for p in pieces.rows()}) == 3


def test_differencing_on_known_partitions():
    sums = lambda sizes, k: sorted(sum(sizes[i] for i in w) for w in P.difference(sizes, k))
    assert sums([8, 7, 6, 5, 4], 2) == [14, 16]  # the textbook case
    assert sums([5, 5, 5, 5], 4) == [5, 5, 5, 5]
    r = random.Random(2)
    for _ in range(50):
        sizes = [r.randrange(1, 513) for _ in range(r.randrange(1, 200))]
        out = P.pack(sizes, 2048)
        assert sorted(i for w in out for i in w) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= 2048 for w in out)
        assert len(out) <= -(-sum(sizes) // 2048) + 1
    assert P.pack([], 2048) == []


def check_pieces(docs, pieces, plain, room=2048):
    """``docs`` as (doc_id, text); rows of one document are told apart by their pieces."""
    want = sorted(((d, tuple(i) + (1,)) for (d, _), i in zip(docs, plain([t or "" for _, t in docs]))), key=repr)
    at, used = {}, {}
    for p in pieces:
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert 0 < p.length <= room
        at.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for spans in used.values():
        upto = 0
        for o, n in sorted(spans):
            assert o == upto
            upto += n
        assert upto <= room
    by_id = {}
    for d, ids in want:
        by_id.setdefault((d, len(ids)), []).append(ids)
    assert set(by_id) == set(at)
    for key, all_ids in by_id.items():
        got = sorted((p.start, bytes(p.ids)) for p in at[key])
        parts = sorted((s, np.array(ids[s:s + n], "<u4").tobytes()) for ids in all_ids
                       for s, n in {(p.start, p.length) for p in at[key]})
        assert got == parts, key
    total = sum(len(i) for _, i in want)
    return total / (len(used) * room)


def test_whole_table(spark, plain):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    pieces = P.pack_documents(spark.read.parquet(f"{sf}/documents.parquet"), PATH).collect()
    assert check_pieces(docs, pieces, plain) > 0.97
    op = {(r.doc_id, r.start): r for r in P.op6_packing(spark, sf).collect()}
    assert len(op) == len(pieces)
    for p in pieces:
        assert op[(p.doc_id, p.start)].ids_crc32 == zlib.crc32(bytes(p.ids))


def test_odd_rows(spark, make_docs, plain):
    long = " ".join(f"long{i}" for i in range(6000))
    rows = [(1, None), (2, ""), (None, "no id"), (3, "twice"), (3, "twice"), (4, long), (5, " \n "), (6, "<|endoftext|>")]
    docs = make_docs(rows, ["1 AS ids", "2 AS length", "3 AS sequence_id"])
    check_pieces(rows, P.pack_documents(docs, PATH).collect(), plain)
    assert P.packing_stage(spark, docs.filter("false"), "").count() == 0
    ids = P.pack_documents(docs.repartition(5), PATH).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert ids.filter("n > 2048").count() == 0


def test_exact_room_fills_a_window(make_docs, plain):
    word = " a" * 2047
    rows = [(1, word), (2, word), (3, word + " a")]
    pieces = P.pack_documents(make_docs(rows), PATH).collect()
    check_pieces(rows, pieces, plain)
    assert sorted(p.length for p in pieces if p.length > 1) == [2048, 2048, 2048] and len(pieces) == 4


def test_added_tokens_are_those_of_the_tokenizer_as_loaded(spark, tmp_path):
    from tokenizers import Tokenizer
    loaded = Tokenizer.from_file(PATH)
    want = lambda texts: [e.ids for e in loaded.encode_batch(texts, add_special_tokens=False)]
    texts = ["<|endoftext|>", None, "plain words.", "a <|endoftext|> b<|endoftext|>", "", "<|endoftext|", "two <|endoftext|>\n x"]
    assert want(["<|endoftext|>"]) == [[50256]]
    ids, at = P.Encoder(PATH, added=True).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want([t or "" for t in texts])
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    check_pieces(rows, P.packing_stage(spark, docs, "").collect(), want)
    op = {r.doc_id: r.ids_crc32 for r in P.op6_packing(spark, str(tmp_path)).collect()}
    assert op == {d: zlib.crc32(np.array([*i, 1], "<u4").tobytes()) for (d, _), i in zip(rows, want([t or "" for t in texts]))}
