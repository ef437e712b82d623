"""Token counts of whole texts, each distinct pre-token being counted once.

A pre-token is a run of characters that no piece of the vocabulary can reach out of: between two
characters that stand side by side in no piece, merges never join, whatever stands around. So
the pieces of a text are those of its pre-tokens, counted one by one.

First every slice of texts gives its distinct pre-tokens with their frequencies, which Spark
sums up; each distinct pre-token is then encoded once and stored with its number of pieces.
Second the documents' frequencies are joined to that table. The most frequent short pre-tokens
(``HEAD`` of at most ``SHORT`` bytes, so 2 MB at most) go to the tasks and are summed where
the document is read; every other pre-token of a document becomes a row (document, pre-token,
frequency) that meets the stored table in a join which Spark can split. Nothing is left out:
the head only saves shuffling the words that everyone uses. A longer pre-token is joined by its
SHA-256, so that one of megabytes, found in a third of all documents, is moved once per slice
and not once per document. No ids of a document are ever made.

Rows: a null or empty text has 0 bytes and 0 tokens; a null or repeated ``doc_id`` is carried,
each row being a document of its own; an empty table gives an empty result; other columns of
the input are not looked at. A very long text is split in one go, at about 40 bytes of memory a
character.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.arrowtext import slices, text_bytes
from rillflow.llm.common import stored
from rillflow.llm.letters import code_points

#: Pre-tokens whose numbers of pieces go to every task, and the longest that may.
HEAD = 65_536
SHORT = 32
BLANK = "▁"  # stands for a space in the vocabulary


class Splitter:
    """Cuts texts into pre-tokens by a vocabulary."""

    def __init__(self, pieces: list[str]):
        longer = [p.replace(BLANK, " ") for p in pieces if len(p) > 1]
        chars = sorted({c for p in longer for c in p})
        self.kinds = len(chars) + 1  # kind 0: in no longer piece
        self.kind = np.zeros(0x110000, np.uint32)
        self.kind[[ord(c) for c in chars]] = np.arange(1, self.kinds)
        self.kind[ord(BLANK)] = self.kind[32]
        joint = np.zeros((self.kinds, self.kinds), bool)
        pairs = sorted({p[i:i + 2] for p in longer for i in range(len(p) - 1)})
        joint[[self.kind[ord(p[0])] for p in pairs], [self.kind[ord(p[1])] for p in pairs]] = True
        self.joint = joint.ravel()

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pre-tokens of all texts, in order, and where each text's begin. A text that is not
        empty has a space put before it, as the tokenizer does."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        space, none = pa.scalar(" ", texts.type), pa.scalar("", texts.type)
        texts = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(space, texts, none))
        buf, off = text_bytes(texts)
        cps, char_off = code_points(texts)
        cut = np.ones(len(cps) + 1, bool)
        if len(cps) > 1:
            kind = self.kind[cps].astype(np.int64)
            cut[1:-1] = ~self.joint[kind[:-1] * self.kinds + kind[1:]]
        cut[char_off] = True
        starts = np.flatnonzero(cut)  # with the end of the last text
        first = np.searchsorted(starts, char_off)
        if len(cps) != len(buf):
            at = np.zeros(len(cps) + 1, np.int64)
            np.cumsum(1 + (cps > 0x7F) + (cps > 0x7FF).astype(np.int8) + (cps > 0xFFFF), out=at[1:])
            starts = at[starts]
        starts = np.ascontiguousarray(starts, np.int64)
        tokens = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1,
                                       [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(buf))])
        return tokens, first


class Counter:
    """Numbers of pieces by a SentencePiece model that leaves texts as they are but for a space
    put before them."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " ﬁ  x "
        if "".join(m.encode(probe, out_type=str)).replace("<0xC2><0xA0>", " ") != BLANK + probe.replace(" ", BLANK):
            raise ValueError(f"{path} rewrites texts before it encodes them")
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())
                  if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.splitter = Splitter(pieces)
        # a character that joins no other stands before each pre-token, so that the space that the
        # tokenizer puts before texts does not meet it
        self.lead = next(c for c in map(chr, [10, 9, 0, *range(0xE000, 0xF8FF)]) if not any(c in p for p in pieces))
        self.spare = len(m.encode(self.lead))

    def pieces(self, tokens: list[bytes]) -> list[int]:
        """How many pieces each pre-token has."""
        ids = self.model.encode([self.lead + t.decode() for t in tokens], num_threads=1)
        return [len(x) - self.spare for x in ids]


@functools.cache
def counter(path: str) -> Counter:
    """One counter per worker process and model."""
    return Counter(path)


def _keys(tokens: pa.Array) -> pa.Array:
    """Short pre-tokens as they are, and 0xFF with the SHA-256 of the others: no UTF-8 has that byte."""
    import hashlib

    long = pc.greater(pc.binary_length(tokens), SHORT)
    if not pc.any(long).as_py():
        return tokens
    given = [b"\xff" + hashlib.sha256(t).digest() for t in tokens.filter(long).to_pylist()]
    return pc.replace_with_mask(tokens, long, pa.array(given, tokens.type))


def count_pieces(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` (text) -> every distinct pre-token once: ``key`` (see ``_keys``), ``n`` (times it
    occurs), ``pieces``."""
    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                tokens = counter(model).splitter.split(part.column("text"))[0].dictionary_encode()
                n = np.bincount(tokens.indices.to_numpy(zero_copy_only=False), minlength=len(tokens.dictionary))
                yield pa.RecordBatch.from_arrays([tokens.dictionary.cast(pa.binary()), pa.array(n)], names=["token", "n"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("token")
            yield pa.RecordBatch.from_arrays(
                [_keys(tokens), batch.column("n"), pa.array(counter(model).pieces(tokens.to_pylist()), pa.int64())],
                names=["key", "n", "pieces"])

    distinct = docs.select("text").mapInArrow(seen, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return stored(distinct.mapInArrow(once, "key binary, n bigint, pieces bigint"), "token_pieces")


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` (doc_id, text) -> ``doc_id``, ``n_bytes``, ``n_tokens`` of every row.

    ``model`` is the path of a SentencePiece BPE model on the executors.
    """
    pieces = count_pieces(docs, model)
    head = pieces.filter(F.length("key") <= SHORT).orderBy(F.desc("n"), "key").limit(HEAD).select("key", "pieces").toArrow()
    known = head.column("key").combine_chunks().cast(pa.large_binary())
    known_pieces = np.append(head.column("pieces").to_numpy(), 0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with the pieces of its known pre-tokens; and for each of its
        other pre-tokens one with the frequency."""
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in slices(batch):
                tokens, first = counter(model).splitter.split(part.column("text"))
                tokens = tokens.dictionary_encode()
                place = pc.fill_null(pc.index_in(tokens.dictionary, known), len(known)).to_numpy(zero_copy_only=False)
                which = tokens.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.concatenate([[0], np.cumsum(known_pieces[place][which])])
                rows = row + np.arange(part.num_rows)
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), part.column("doc_id"),
                     pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64()),
                     pa.array(np.diff(upto[first])), pa.nulls(part.num_rows, pa.binary()), pa.nulls(part.num_rows, pa.int64())],
                    names=names)
                other = np.flatnonzero(place[which] == len(known))
                if len(other):
                    doc = np.repeat(np.arange(part.num_rows), np.diff(first))[other]
                    pair, n = np.unique(doc * len(place) + which[other], return_counts=True)
                    keys = _keys(tokens.dictionary.take(pa.array(pair % len(place))).cast(pa.binary()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[pair // len(place)]), pa.nulls(len(pair), part.column("doc_id").type),
                         pa.nulls(len(pair), pa.int64()), pa.nulls(len(pair), pa.int64()), keys, pa.array(n)], names=names)

    names = ["row", "doc_id", "n_bytes", "known", "key", "n"]
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("known", T.LongType()),
                           T.StructField("key", T.BinaryType()), T.StructField("n", T.LongType())])
    rows = stored(docs.select("doc_id", "text").mapInArrow(sums, schema), "token_frequencies")
    rest = rows.filter("key IS NOT NULL").select("row", "key", "n").join(pieces.select("key", "pieces"), "key") \
        .groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    return rows.filter("key IS NULL").join(rest, "row", "left").select(
        "doc_id", "n_bytes", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_tokens"))


def _model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, _model_path()).withColumn("over_limit", F.col("n_tokens") > 4096)
