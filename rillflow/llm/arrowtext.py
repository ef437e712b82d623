"""Words of a batch of texts as numpy arrays, taken from Arrow's buffers without a Python loop."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of text that are worked on at once, unless one text alone is longer.
SLICE_BYTES = 2 << 20


class Words(NamedTuple):
    """``buf[starts[i]:ends[i]]`` is word i; text d has the words ``first[d]`` to ``first[d + 1]``."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def of_text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 in one array, and where each begins; a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data and len(texts) else np.zeros(0, np.uint8)
    return buf, off - off[0]


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Runs of characters that are no ASCII white space; ``lower`` turns A-Z to a-z first."""
    buf, off = text_bytes(texts)
    if lower:
        buf = _LOWER[buf]
    n = len(buf)
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = ~_BLANK[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    return Words(buf, starts, ends, np.searchsorted(starts, off))


def joined(w: Words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes, each with a space behind it, and where each word begins there; the
    last entry is the length. With ``keep`` only those words, the others having no bytes."""
    lens = w.ends - w.starts + 1
    if keep is not None:
        lens = np.where(keep, lens, 0)
    at = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=at[1:])
    source = np.repeat(w.starts - at[:-1], lens) + np.arange(at[-1])
    last = at[1:][lens > 0] - 1
    source[last] = 0
    out = w.buf[source] if len(source) else np.zeros(0, np.uint8)
    out[last] = 32
    return out, at


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in turn, cut into runs whose texts have at most ``most`` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, side="right")))
        yield batch.slice(a, b - a)
        a = b


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step (splitmix64): nearby values become unrelated ones."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct spans of bytes (or of code points, as their bytes) as binary values, and which of
    them each span is. Spans are told apart by all their bytes, not by a hash."""
    width, n = buf.itemsize, len(starts)
    upto = np.zeros(n + 1, np.int64)
    np.cumsum(ends - starts, out=upto[1:])
    if n and upto[-1] == len(buf) and np.array_equal(upto[:-1], starts):
        data = buf
    else:
        data = buf[np.repeat(starts - upto[:-1], np.diff(upto)) + np.arange(upto[-1])]
    spans = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(upto * width), pa.py_buffer(np.ascontiguousarray(data))])
    coded = spans.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def as_bytes(values: pa.Array) -> list[bytes]:
    """Binary values, none of them null, as Python's; many times faster than ``to_pylist``."""
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    off = np.frombuffer(values.buffers()[1], kind)[values.offset:values.offset + len(values) + 1].tolist() if len(values) else []
    data = values.buffers()[2].to_pybytes() if len(values) and values.buffers()[2] else b""
    return [data[a:b] for a, b in zip(off, off[1:])]


def digests(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """128 bits (XXH3) of each value, as two arrays of 64."""
    import xxhash

    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, as_bytes(values))), ">u8").reshape(-1, 2).astype(np.uint64)
    return both[:, 0], both[:, 1]
