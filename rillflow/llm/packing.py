"""Packing token streams into windows of equal room by multiway differencing.

Every document's tokens end with the end token. A document longer than a window fills whole
windows first; what is left is cut into pieces and packed, group by group, by Karmarkar-Karp
differencing: the two partial partitions with the largest imbalance are merged so that the
fullest window of one meets the emptiest of the other, until one partition is left. A group
closes as soon as its tokens fill ``GROUP`` windows (or its pieces are many); the piece that is
too much begins the next group, so hardly any room is lost, whether texts are long or short. The
number of windows starts at the fewest that could hold the group and rises while one exceeds
its room. Where a document is cut depends on its own length alone, so its copies are cut alike.

Groups are runs of pieces of one input partition. What is left at a partition's end, too little
for a group, is packed in a second pass: the left-over pieces of all partitions, dealt at random
into groups of about ``AGAIN`` windows each, so that many small partitions lose no more than a
few large ones. The first pass is stored; a lost executor's part of it is done again, with the
same result. A source, key or copy that has a third of all rows changes nothing.

A task holds one group's ids, the ids of one slice of texts (2 MB, or one longer text: about 30
bytes of memory a byte), and at most ``KEPT_BYTES`` of parts it has encoded before.

Rows: a null or empty text has the end token alone; a null or repeated ``doc_id`` is carried,
each row being a document of its own; an empty table gives an empty result; other columns of
the input are not looked at.
"""

from __future__ import annotations

import functools
import heapq
import os
from bisect import insort
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.arrowtext import as_bytes, slices, text_bytes
from rillflow.llm.common import stored

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"

#: Windows whose pieces are packed together, and pieces at most: then a group is packed as far as it
#: fills windows.
GROUP, GROUP_PIECES = 64, 2_048
#: Share of a window that is left free, so that near-equal windows fit.
SLACK = 0.004
#: Windows of a group of the second pass, about.
AGAIN = 512
#: Bytes that a worker keeps of the parts of texts it has encoded (with what each costs besides its
#: letters), and the longest part that is kept.
KEPT_BYTES = 96 << 20
PART_COST = 150
LONGEST_KEPT = 256

_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(range(65, 91)) + list(range(97, 123))] = True
_SEEN = np.zeros(256, bool)  # ASCII that is neither white space nor a control character
_SEEN[33:127] = True
#: What may begin a word behind a space: no ASCII white space or control character, and none of
#: the bytes that the white space of Unicode begins with.
_BEGINS = _SEEN.copy()
_BEGINS[128:] = True
_BEGINS[[0xC2, 0xE1, 0xE2, 0xE3]] = False


def part_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where texts may be cut without changing their tokens; every text's beginning is one.

    The tokenizer first splits a text into runs of letters, of digits, of other signs and of
    white space, where a space goes with the run behind it and the last of several white space
    characters stands alone. So whatever stands around it a text is split: before a space that
    a sign follows; between a letter and a mark; between a sign and a line's end; and, if that
    line's end is alone, between it and a letter.
    """
    n = len(buf)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        joint = ~edge[1:n]  # places whose byte before is of the same text
        prev, this = buf[:-1], buf[1:]
        line = (this == 10) & _SEEN[prev] & joint
        cut[1:n] = line | (_MARK[this] & _LETTER[prev] & joint)
        cut[2:n] |= line[:-1] & _LETTER[this[1:]] & joint[1:]
        cut[:n - 1] |= (prev == 32) & _BEGINS[this] & joint
    cut[off] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Token ids of texts, by a tokenizer that is asked once for each distinct part.

    Parts are kept as they are, up to ``kept`` bytes; beyond it all are forgotten. With ``added`` the
    file's added special tokens are found in texts, as by the tokenizer as loaded; else they are
    spelled out. A text that holds an added token is encoded whole.
    """

    def __init__(self, path: str, kept: int = KEPT_BYTES, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if added or not t.special]
        (self.newline,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.kept = kept
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.bytes = 0
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _ask(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All their ids, and how many each has."""
        ids = [e.ids for a in range(0, len(texts), 20_000)
               for e in self.tokenizer.encode_batch_fast(texts[a:a + 20_000], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int32, len(ids))

    def _ask_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of distinct parts: words behind a space are asked for by lines of many, as a
        line's end behind a letter and before a space is a token of its own."""
        word = np.fromiter((p[0] == " " and p[1:].isalpha() for p in parts), bool, len(parts))
        words, rest = [p for p, w in zip(parts, word) if w], [p for p, w in zip(parts, word) if not w]
        lines, _ = self._ask(["\n".join(words[a:a + 64]) + "\n" for a in range(0, len(words), 64)])
        ids, count = self._ask(rest)
        ends = np.flatnonzero(lines == self.newline)
        counts = np.empty(len(parts), np.int32)
        counts[word] = np.diff(ends, prepend=-1) - 1
        counts[~word] = count
        out = np.empty(counts.sum(), np.uint32)
        of_word = np.repeat(word, counts)
        out[of_word] = lines[lines != self.newline]
        out[~of_word] = ids
        return out, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's begin."""
        whole = np.zeros(len(texts), bool)
        for mark in self.marks:
            whole |= pc.fill_null(pc.match_substring(texts, mark), False).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._encode_parts(texts)
        ids, at = self._encode_parts(pc.if_else(pa.array(whole), pa.scalar("", texts.type), texts))
        own, count = self._ask(texts.filter(pa.array(whole)).to_pylist())
        counts = np.diff(at)
        counts[whole] = count
        of_whole = np.repeat(whole, counts)
        out = np.empty(len(of_whole), np.uint32)
        out[of_whole], out[~of_whole] = own, ids
        return out, np.concatenate([[0], np.cumsum(counts)])

    def _encode_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts without an added token, by their parts."""
        buf, off = text_bytes(texts)
        start = part_starts(buf, off)
        ends = np.append(start, len(buf)).astype(np.int64)
        parts = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(buf))])
        parts = parts.dictionary_encode()
        part = parts.indices.to_numpy(zero_copy_only=False)
        distinct = as_bytes(parts.dictionary)
        if self.bytes > self.kept:
            self._forget()
        place = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        firsts, counts, all_ids = self.first, self.count, self.ids
        new = np.flatnonzero(place < 0)
        if len(new):
            long = np.fromiter((len(distinct[i]) > LONGEST_KEPT for i in new), bool, len(new))
            new = np.concatenate([new[~long], new[long]])  # the first ones are kept
            ids, count = self._ask_parts([distinct[i].decode() for i in new])
            place[new] = len(firsts) + np.arange(len(new))
            firsts = np.concatenate([firsts, len(all_ids) + np.cumsum(count) - count])
            counts = np.concatenate([counts, count])
            all_ids = np.concatenate([all_ids, ids])
            more = int((~long).sum())
            self.place.update((distinct[i], int(place[i])) for i in new[:more])
            size = len(self.first) + more
            self.first, self.count = firsts[:size], counts[:size]
            self.ids = all_ids[:len(self.ids) + int(count[:more].sum())]
            if long.any():
                self.first, self.count, self.ids = self.first.copy(), self.count.copy(), self.ids.copy()
            self.bytes += sum(len(distinct[i]) for i in new[:more]) + PART_COST * more
        first, count = firsts[place][part], counts[place][part]
        upto = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=upto[1:])
        ids = all_ids[np.repeat(first - upto[:-1], count) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(start, off)]


@functools.cache
def encoder(path: str, added: bool = False) -> Encoder:
    """One encoder per worker process, tokenizer file and way with added tokens."""
    return Encoder(path, added=added)


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """The items of each of ``windows`` near-equal windows (Karmarkar-Karp).

    A partial partition is its used windows, (sum, node) ascending, the others being empty, and
    what to take off every sum, so that its least is 0. Nodes are items, or pairs of nodes.
    """
    n = len(sizes)
    pairs: list[tuple[int, int]] = []
    heap = [(-size, i, 0, [(size, i)]) for i, size in enumerate(sizes)]
    if windows == 1:
        return [list(range(n))]
    heapq.heapify(heap)
    order = n
    while len(heap) > 1:
        _, _, off, used = heapq.heappop(heap)
        _, _, other_off, other = heapq.heappop(heap)
        if len(used) < len(other):
            off, used, other_off, other = other_off, other, off, used
        empty = windows - len(used)
        if len(other) <= empty:
            used = sorted(used + other)
        else:
            # the fullest of one meets the emptiest of the other
            met = [(size - other_off, node) for size, node in reversed(other[-empty:])] if empty else []
            rest = other[:len(other) - empty]
            for (size, node), (more, node2) in zip(used, reversed(rest)):
                met.append((size + more - other_off, n + len(pairs)))
                pairs.append((node, node2))
            used = used[len(rest):]
            if len(met) == 1:
                insort(used, met[0])
            else:
                used = sorted(used + met)
        off = used[0][0] if len(used) == windows else 0
        heapq.heappush(heap, (off - used[-1][0], order, off, used))
        order += 1
    out = []
    for _, node in heap[0][3] if heap else []:
        items, todo = [], [node]
        while todo:
            x = todo.pop()
            if x < n:
                items.append(x)
            else:
                todo += pairs[x - n]
        out.append(items)
    return out


def pack(sizes: list[int], room: int) -> list[list[int]]:
    """Windows of items with at most ``room`` in each; none of ``sizes`` is larger."""
    total = sum(sizes)
    windows = max(1, -(-total // room))
    while sizes:
        out = difference(sizes, windows)
        over = max(sum(sizes[i] for i in w) for w in out)
        if over <= room:
            return [w for w in out if w]
        windows += 1
    return []


class Pieces:
    """Pieces of documents (doc_id, start, ids, doc_tokens) on their way into windows of ``room``."""

    def __init__(self, room: int, first: int):
        self.room, self.next = room, first
        self.held: list[tuple] = []
        self.size = 0
        self.done: list[tuple] = []

    def add(self, doc, start: int, ids: bytes, tokens: int) -> None:
        self.held.append((doc, start, ids, tokens))
        self.size += len(ids) // 4

    def whole(self, doc, start: int, ids: bytes, tokens: int) -> None:
        """A piece that is a window by itself."""
        self.done.append((doc, start, ids, tokens, self.next, 0))
        self.next += 1

    def pack(self, all_of_it: bool = False) -> None:
        """Packs what fills windows, if that is enough for a group; or all of it."""
        meant = max(1, int(self.room * (1 - SLACK)))  # tokens for each window
        while self.held:
            n = size = 0
            while n < len(self.held) and size < GROUP * meant and (n < GROUP_PIECES or size < meant):
                size += len(self.held[n][2]) // 4
                n += 1
            if size >= GROUP * meant or n >= GROUP_PIECES and size >= meant:
                most = min(GROUP, size // meant) * meant
                while size > most and n > 1:  # what doesn't fit is the next group's: pieces are never cut
                    n -= 1
                    size -= len(self.held[n][2]) // 4
            elif not all_of_it:
                return
            self._pack(n)

    def _pack(self, n: int) -> None:
        """Packs the first ``n`` pieces."""
        some, self.held = self.held[:n], self.held[n:]
        self.size -= sum(len(x[2]) // 4 for x in some)
        for window in pack([len(x[2]) // 4 for x in some], self.room):
            at = 0
            for i in window:
                self.done.append((*some[i], self.next, at))
                at += len(some[i][2]) // 4
            self.next += 1

    def rows(self) -> list[tuple]:
        """The pieces that have a window, as rows of ``PIECES``; they are forgotten."""
        out = [(doc, start, len(ids) // 4, ids, tokens, window, at) for doc, start, ids, tokens, window, at in self.done]
        self.done = []
        return out


_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
_NAMES = [x.split()[0] for x in PIECES.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)


def pack_documents(docs: DataFrame, tokenizer: str, room: int = 2048, end_id: int = 1,
                   piece: int = 512, added: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) -> the pieces of the packed windows.

    ``tokenizer`` is the path of a tokenizer file on the executors; ``piece`` the longest piece
    that is not a whole window; ``added`` finds the tokenizer's added special tokens in texts
    instead of spelling them out. A row per piece: its document and place there, its ids, and its
    window and place there. Windows get numbers unique over the partitions.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer, added)
        end = np.array([end_id], "<u4").tobytes()
        pieces = Pieces(room, TaskContext.get().partitionId() << 36)
        for batch in batches:
            for part in slices(batch):
                ids, at = tokens.encode(part.column("text"))
                data, at = ids.astype("<u4").tobytes(), (4 * at).tolist()
                for d, x, y in zip(part.column("doc_id").to_pylist(), at, at[1:]):
                    own = data[x:y] + end
                    n = len(own) // 4
                    rest = n // room * room
                    for s in range(0, rest, room):
                        pieces.whole(d, s, own[4 * s:4 * (s + room)], n)
                    for s in range(rest, n, piece):
                        pieces.add(d, s, own[4 * s:4 * min(n, s + piece)], n)
                    if len(pieces.held) >= GROUP_PIECES or pieces.size >= GROUP * room:
                        pieces.pack()
                if rows := pieces.rows():
                    yield _batch(rows)
        if pieces.held:  # too little for a group: the order in this partition takes the window's place
            yield _batch([(d, s, len(i) // 4, i, n, None, pieces.next + k) for k, (d, s, i, n) in enumerate(pieces.held)])

    first = stored(docs.select("doc_id", "text").mapInArrow(run, PIECES), "packing_pieces")
    left = first.filter("sequence_id IS NULL")
    groups = (left.agg(F.sum("length")).first()[0] or 0) // (AGAIN * room) + 1

    def again(rows: pa.Table) -> pa.Table:
        pieces = Pieces(room, (1 << 62) + (rows.column("group")[0].as_py() << 36))
        columns = rows.sort_by("offset").select(["doc_id", "start", "ids", "doc_tokens"]).columns
        for row in zip(*(c.to_pylist() for c in columns)):
            pieces.add(*row)
        pieces.pack(all_of_it=True)
        return pa.Table.from_batches([_batch(pieces.rows())])

    dealt = left.withColumn("group", F.pmod(F.xxhash64("offset"), F.lit(groups)))
    return first.filter("sequence_id IS NOT NULL").unionByName(dealt.groupBy("group").applyInArrow(again, PIECES))


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of all packed documents, with a checksum of their ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = pack_documents(docs, _tokenizer_path(), added=True).withColumn("ids_crc32", F.crc32("ids"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents, ids and all."""
    out = pack_documents(docs, _tokenizer_path(), added=True).withColumn("ids_crc32", F.crc32("ids"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")
