"""Removing passages that repeat across documents, by doubling the length level by level.

A passage of ``length`` words can only repeat in another document if both halves of it do.
So the windows of about half the length are looked at first, then, in documents, those twice
as long of which both halves repeat, up to ``length``; a level without repeats ends the search.

Documents are stored in chunks, one row each, with all their columns. On every level a chunk
sends the hashes of its candidate windows, sorted and cut by their leading bits, one message
per range of hashes; the ranges are many enough that the values of one fit in a task. A window
is sent once per chunk however often it occurs there, so a passage in a third of all documents
costs a value per chunk. A chunk is one row: a very long text takes about 60 bytes of memory
a byte in the task that reads it. The answer for each message is one bit per value. Chunks
and answers meet by the chunk's number, so the texts are shuffled, compressed, once per level.

A word stands as 128 bits of hash (XXH3), a window as two sums over the halves of its words' hashes.
Below the last level a bit says that the window's first sum (32 bits and the range's) occurs in
two documents; a clash only keeps a candidate longer. On the last level 64 bits of the first and
32 of the second sum stand for the window, and the bit says that a document with a smaller id
than any of the chunk's has it.

Rows: a null or empty text has no words and nothing removed; a null ``doc_id`` is larger than
any other, and documents with equal ids (or none) do not remove from each other; repeated rows
are judged alike; an empty table gives an empty result. The columns ``n_words``,
``n_removed`` and ``kept_sha256`` replace columns of the input with these names; the stage leaves
every column as it is, whatever its name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.arrowtext import Words, digests, distinct_spans, joined, mixed, slices, split_words
from rillflow.llm.common import set_aside, stored

ADDED = ("n_words", "n_removed", "kept_sha256")
#: Values that one range of hashes holds on the first level, about.
RANGE_VALUES = 1 << 21
NO_ID = np.iinfo(np.int64).max


def levels(length: int, base: int) -> list[int]:
    """``length`` halved while above ``base``, the shortest first: 13 by base 7 is 7, 13."""
    out = [length]
    while out[0] > base:
        out.insert(0, (out[0] + 1) // 2)
    return out


def window_hashes(word: np.ndarray, length: int, at: np.ndarray) -> np.ndarray:
    """A hash of the ``length`` words from each place in ``at``."""
    h = np.zeros(len(at), np.uint64)
    for j in range(length):
        h = h * np.uint64(0x9E6C63D0676A9A99) + word[at + j]
    return mixed(h)


class Chunk:
    """Documents, their words, and the search as far as the answers go."""

    def __init__(self, data: bytes, lengths: list[int], bits: int):
        self.table = pa.ipc.open_stream(data).read_all().combine_chunks()
        self.batch = self.table.to_batches()[0]
        ids = pc.fill_null(self.batch.column("doc_id").cast(pa.int64()), NO_ID)
        self.ids = ids.to_numpy(zero_copy_only=False)
        self.words: Words = split_words(self.batch.column("text"))
        self.text_of = self.words.of_text()
        values, of_word = distinct_spans(self.words.buf, self.words.starts, self.words.ends)
        self.hash, self.other = (h[of_word] for h in digests(values))
        self.lengths, self.bits = lengths, bits

    def inside(self, at: np.ndarray, length: int) -> np.ndarray:
        """Those of ``at`` from where ``length`` words are in one document."""
        return at[at + length <= self.words.first[1:][self.text_of[at]]]

    def search(self, answers: list[tuple[int, int, bytes]]):
        """Follows the answers level by level; (level, its candidates) where they end, or None
        for the candidates if none are left."""
        by_level: dict[int, list] = {}
        for level, part, bits in answers:
            by_level.setdefault(level, []).append((part, bits))
        at = self.inside(np.arange(len(self.hash)), self.lengths[0])
        for k, length in enumerate(self.lengths):
            c = Candidates(self, at, length, last=k == len(self.lengths) - 1)
            if k not in by_level or not len(at):
                return k, c if len(at) else None
            c.take(sorted(by_level[k]))
            if c.last:
                return k, c
            alive = np.zeros(len(self.hash) + length + 1, bool)
            alive[at[c.yes[c.group]]] = True
            longer = self.lengths[k + 1]
            at = at[alive[at] & alive[at + longer - length]]
            at = self.inside(at, longer)
        raise AssertionError("no level")


class Candidates:
    """Windows of one length in a chunk, grouped by hash, in the order of the hashes."""

    def __init__(self, chunk: Chunk, at: np.ndarray, length: int, last: bool):
        self.at, self.last, self.bits = at, last, chunk.bits
        key = window_hashes(chunk.hash, length, at)
        doc = chunk.text_of[at]
        if last:
            more = window_hashes(chunk.other, length, at) & np.uint64(0xFFFFFFFF)
            order = np.lexsort((more, key))
            more = more[order]
        else:
            key = key >> np.uint64(32 - chunk.bits)
            order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        if last:
            new[1:] |= more[1:] != more[:-1]
        heads = np.flatnonzero(new)
        self.group = np.empty(len(key), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.key = key[heads]
        self.part = (self.key >> np.uint64(64 - self.bits if last else 32)).astype(np.int64)
        if last:
            self.more = more[heads].astype(np.uint32)
            self.least = np.minimum.reduceat(chunk.ids[doc], heads) if len(heads) else np.zeros(0, np.int64)
        else:
            other = np.ones(len(key), bool)
            other[1:] = doc[1:] != doc[:-1]
            other |= new
            self.several = np.add.reduceat(other.astype(np.int64), heads) > 1 if len(heads) else np.zeros(0, bool)

    def messages(self) -> Iterator[tuple[int, bytes]]:
        """(range, its values): sorted 32-bit steps and a bit each, or key, more, least id."""
        parts, heads = np.unique(self.part, return_index=True)
        for p, a, b in zip(parts.tolist(), heads.tolist(), [*heads[1:].tolist(), len(self.part)]):
            if self.last:
                yield p, self.key[a:b].tobytes() + self.more[a:b].tobytes() + self.least[a:b].tobytes()
            else:
                low = (self.key[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                yield p, np.diff(low, prepend=np.uint32(0)).tobytes() + np.packbits(self.several[a:b]).tobytes()

    def take(self, answers: list[tuple[int, bytes]]) -> None:
        size = dict(zip(*(x.tolist() for x in np.unique(self.part, return_counts=True))))
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=size[p]) for p, b in answers]
        self.yes = np.concatenate(bits).astype(bool)


def answer_repeats(blobs: list[bytes]) -> list[bytes]:
    """Which values of each message occur in two documents."""
    values, several = [], []
    for b in blobs:
        n = len(b) * 8 // 33
        values.append(np.cumsum(np.frombuffer(b, np.uint32, n), dtype=np.uint64).astype(np.uint32))
        several.append(np.unpackbits(np.frombuffer(b, np.uint8, offset=4 * n), count=n).astype(bool))
    v = np.concatenate(values)
    order = np.argsort(v, kind="stable")
    v = v[order]
    same = np.zeros(len(v) + 1, bool)
    same[1:-1] = v[1:] == v[:-1]
    yes = np.empty(len(v), bool)
    yes[order] = same[1:] | same[:-1]
    yes |= np.concatenate(several)
    # two equal values of which any is in several documents are equal, hence repeated, anyway
    return _cut(yes, [len(x) for x in values])


def answer_smaller(blobs: list[bytes]) -> list[bytes]:
    """Which windows of each message are in a document with an id below the message's least."""
    ns = [len(b) // 20 for b in blobs]
    key = np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in zip(blobs, ns)])
    more = np.concatenate([np.frombuffer(b, np.uint32, n, offset=8 * n) for b, n in zip(blobs, ns)])
    least = np.concatenate([np.frombuffer(b[12 * n:], np.int64, n) for b, n in zip(blobs, ns)])
    order = np.lexsort((least, more, key))
    k, m, i = key[order], more[order], least[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    smallest = i[np.flatnonzero(new)][np.cumsum(new) - 1]
    yes = np.empty(len(k), bool)
    yes[order] = smallest < i
    return _cut(yes, ns)


def _cut(yes: np.ndarray, sizes: list[int]) -> list[bytes]:
    return [np.packbits(x).tobytes() for x in np.split(yes, np.cumsum(sizes)[:-1])]


def _chunks(docs: DataFrame) -> DataFrame:
    """``chunk, data, words``: runs of documents as compressed Arrow streams, with all columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array([out.getvalue().to_pybytes()], pa.binary()),
                    pa.array([len(split_words(part.column("text")).starts)], pa.int64())], names=["data", "words"])

    rows = docs.mapInArrow(run, "data binary, words bigint")
    return stored(rows.withColumn("chunk", F.monotonically_increasing_id()), "substring_chunks")


ANSWER = "chunk bigint, level int, part bigint, bits binary"


def _with_answers(chunks: DataFrame, answers: DataFrame | None) -> DataFrame:
    """``chunk, data, answers`` in one row per chunk."""
    if answers is None:
        none = F.array().cast("array<struct<level:int,part:bigint,bits:binary>>")
        return chunks.select("chunk", "data", none.alias("answers"))
    given = answers.groupBy("chunk").agg(F.collect_list(F.struct("level", "part", "bits")).alias("answers"))
    return chunks.select("chunk", "data").join(given, "chunk", "left")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, list]]:
    for batch in batches:
        for i in range(batch.num_rows):
            given = batch.column("answers")[i].as_py() or []
            yield batch.column("chunk")[i].as_py(), batch.column("data")[i].as_py(), \
                [(a["level"], a["part"], a["bits"]) for a in given]


def _ask(chunks: DataFrame, answers: DataFrame | None, level: int, lengths: list[int], bits: int) -> DataFrame:
    """The answers of one level, stored; no rows if no candidates are left."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, data, given in _rows(batches):
            at, c = Chunk(data, lengths, bits).search(given)
            if c is None or at != level:
                continue
            part, values = zip(*c.messages())
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(part), pa.int64()), pa.array(part, pa.int64()),
                                              pa.array(values, pa.binary())], names=["chunk", "part", "message"])

    reply = answer_smaller if level == len(lengths) - 1 else answer_repeats

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": rows["chunk"], "level": level, "part": rows["part"],
                             "bits": reply(rows["message"].tolist())})

    sent = _with_answers(chunks, answers).mapInArrow(send, "chunk bigint, part bigint, message binary")
    return stored(sent.groupBy("part").applyInPandas(meet, ANSWER), "substring_answers")


def dedup_substrings(docs: DataFrame, length: int = 13, base: int = 7) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by a
    space), and as ``text`` the kept words joined by a space where any word was removed.

    A word is removed if it is in a window of ``length`` words that also starts in a document
    with a smaller ``doc_id``, judged on the texts as given.
    """
    docs = docs.drop(*ADDED)
    lengths = levels(length, base)
    chunks = _chunks(docs)
    words = chunks.agg(F.sum("words")).first()[0] or 0
    bits = min(31, max(8, math.ceil(math.log2(max(words, 1) / RANGE_VALUES))))
    answers = None
    for level in range(len(lengths)):
        got = _ask(chunks, answers, level, lengths, bits)
        answers = got if answers is None else answers.unionByName(got)
        if got.isEmpty():
            break

    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, given in _rows(batches):
            yield _finished(Chunk(data, lengths, bits), given)

    return _with_answers(chunks, answers).mapInArrow(finish, schema)


def _finished(chunk: Chunk, given: list) -> pa.RecordBatch:
    """The chunk's documents without the words that its answers say are covered."""
    w, (level, c) = chunk.words, chunk.search(given)
    removed = np.zeros(len(w.starts), bool)
    if c is not None and c.last and any(a[0] == level for a in given):
        covered = c.yes[c.group] | (chunk.ids[chunk.text_of[c.at]] > c.least[c.group])
        step = np.zeros(len(removed) + 1, np.int64)
        np.add.at(step, c.at[covered], 1)
        np.add.at(step, c.at[covered] + chunk.lengths[level], -1)
        removed = np.cumsum(step)[:-1] > 0
    buf, at = joined(w, ~removed)
    data, first = buf.tobytes(), at[w.first].tolist()
    kept = [data[a:max(a, b - 1)] for a, b in zip(first, first[1:])]
    upto = np.concatenate([[0], np.cumsum(removed)])[w.first]
    n_removed = np.diff(upto)
    texts = chunk.batch.column("text").to_pylist()
    texts = [k.decode() if n else t for t, k, n in zip(texts, kept, n_removed.tolist())]
    columns = [pa.array(texts, chunk.batch.schema.field("text").type) if name == "text" else chunk.batch.column(name)
               for name in chunk.batch.schema.names]
    columns += [pa.array(np.diff(w.first)), pa.array(n_removed),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=[*chunk.batch.schema.names, *ADDED])


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", *ADDED)


def substring_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the repeated passages; columns as given."""
    given, names = set_aside(docs, ("doc_id", "text", "n_chars"))
    out = dedup_substrings(given)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*names).toDF(*docs.columns)
