"""Words of letters of a batch of texts, and their character n-grams, as numpy arrays."""

from __future__ import annotations

import functools
import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rillflow.llm.arrowtext import Words, distinct_spans, mixed


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters, and each one's lower case where that is one character."""
    n = sys.maxunicode + 1
    letter, lower = np.zeros(n, bool), np.arange(n, dtype=np.uint32)
    for i in range(n):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    return letter, lower


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' code points in one array, and where each begins; a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), out=off[1:])
    return np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32), off


def letter_words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Runs of letters, in lower case, and where each text begins in their buffer."""
    cps, off = code_points(texts)
    letter, lower = _tables()
    solid = np.zeros(len(cps) + 2, bool)
    solid[1:-1] = letter[cps]
    edge = np.zeros(len(cps) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    return Words(lower[cps], starts, ends, np.searchsorted(starts, off)), off


class Distinct(NamedTuple):
    """The distinct words: ``chars[first[i]:first[i + 1]]`` is one; ``of_word`` leads to them."""

    chars: np.ndarray
    first: np.ndarray
    of_word: np.ndarray


def distinct(w: Words, before: int = 1, after: int = 1) -> Distinct:
    """The distinct words between so many zeros, the marks of a word's ends."""
    values, of_word = distinct_spans(w.buf, w.starts, w.ends)
    upto = np.frombuffer(values.buffers()[1], np.int64)[:len(values) + 1] // w.buf.itemsize
    lens = np.diff(upto)
    first = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens + before + after, out=first[1:])
    chars = np.zeros(first[-1], np.uint32)
    inner = np.repeat(first[:-1] + before - upto[:-1], lens) + np.arange(upto[-1])
    chars[inner] = np.frombuffer(values.buffers()[2] or b"", w.buf.dtype)[:upto[-1]]
    return Distinct(chars, first, of_word)


def gram_slots(chars: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The slot, of 2^bits, of the n-gram at each place of ``chars`` but the last n - 1."""
    h = np.full(max(0, len(chars) - n + 1), n, np.uint64)
    for j in range(n):
        h = h * np.uint64(0x9E6C63D0676A9A99) + chars[j:j + len(h)].astype(np.uint64)
    return (mixed(h) >> np.uint64(64 - bits)).astype(np.int64)


def grams(d: Distinct, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, slot) of every n-gram inside a distinct word and its end marks."""
    slots = gram_slots(d.chars, n, bits)
    word = np.repeat(np.arange(len(d.first) - 1), np.diff(d.first))[:len(slots)]
    inside = np.arange(len(slots)) + n <= d.first[1:][word]
    return word[inside], slots[inside]
