"""Distinct words are told apart by all their letters."""

import numpy as np
import pyarrow as pa

from rillflow.llm import language as L
from rillflow.llm import toxicity as X
from rillflow.llm.letters import distinct, letter_words


def pair():
    """A string of 1,024 letters and its complement: one polynomial hash modulo 2^64."""
    thue = "a"
    for _ in range(10):
        thue += thue.translate(str.maketrans("ab", "ba"))
    return thue, thue.translate(str.maketrans("ab", "ba"))


def words_of(d):
    return ["".join(chr(c) for c in d.chars[a:b] if c) for a, b in zip(d.first, d.first[1:])]


def test_distinct_words():
    a, b = pair()
    texts = [f"{a} x {b}", None, "", f"X {b} é É 漢字 x1x", "..."]
    w, _ = letter_words(pa.array(texts))
    for before, after in ((1, 1), (2, 1), (0, 0)):
        d = distinct(w, before, after)
        seen = words_of(d)
        assert len(seen) == len(set(seen)) == 5
        assert [seen[i] for i in d.of_word] == [a, "x", b, "x", b, "é", "é", "漢字", "x", "x"]
        lens = np.diff(d.first) - before - after
        assert lens.tolist() == [len(x) for x in seen]


def test_operators_keep_such_words_apart():
    a, b = pair()
    gram, n = L.counts_of(pa.array([f"{a} {b}"]))
    one, two = L.counts_of(pa.array([a])), L.counts_of(pa.array([b]))
    total = {}
    for g, c in (*zip(*map(np.ndarray.tolist, one)), *zip(*map(np.ndarray.tolist, two))):
        total[g] = total.get(g, 0) + c
    assert dict(zip(gram.tolist(), n.tolist())) == total
    text, slot, value = X.features(pa.array([a, b, f"{a} {b}"]))
    assert set(slot[text == 2]) == set(slot[text == 0]) | set(slot[text == 1])


def test_no_words():
    w, _ = letter_words(pa.array([None, "", "1 2"]))
    d = distinct(w)
    assert len(d.first) == 1 and len(d.chars) == 0 and len(d.of_word) == 0
