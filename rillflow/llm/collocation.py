"""Collocations: phrases whose words occur together more often than their parts do.

Every word of a piece of text begins a suffix, looked at up to ``longest`` words deep. Suffixes
are routed by their leading words: the order of all suffixes is cut into ranges of about
``RANGE`` suffixes, at places taken from a bounded sample (which decides how even the ranges
are, and no result). Each range is one group; in it pointers to suffixes are sorted by multikey
three-way quicksort. A partition is parted by the word at its depth into those below, at and
above a pivot; the equal one is the set of suffixes that begin with one phrase, so its size is
that phrase's count, and it goes on one word deeper. A partition smaller than ``least`` is
abandoned at once: no phrase in it can be frequent. All partitions of a range are parted in the
same numpy steps.

A phrase with a third of all occurrences may span ranges, since a range ends wherever the order
is cut, after any number of words. Only phrases that begin a range's first or last suffix can:
these are handed on with their part of the count, however small, and summed up. Suffixes are
sent in chunks, equal ones of a chunk once with their number, so copies of a passage cost a
row per chunk. Counts, cuts and ranks of the frequent phrases are DataFrame functions.

Rows: a null or empty text has no words; a null ``lang`` is ``und``; rows are counted one by
one, repeated or not; an empty table gives an empty result; other columns of the input are not
looked at. One very long text is split in one go, at about 60 bytes of memory a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.arrowtext import as_bytes, slices, text_bytes
from rillflow.llm.common import stored

#: Suffixes that one range holds, about.
RANGE = 1_500_000
#: Bytes of text whose suffixes are sent together.
CHUNK_BYTES = 4 << 20
#: Sampled suffixes per chunk, and for each range, and altogether at most.
PICKS, PICKS_A_RANGE, MOST_PICKS = 64, 50, 200_000

_STOP = np.zeros(256, bool)
_STOP[[*b".,;:!?", 10, 11, 12, 13]] = True
_BLANK = _STOP.copy()
_BLANK[[9, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Suffixes:
    """Words of a batch of texts as ranks (from 1) among its distinct words in the order of their
    bytes, and of each word's piece how much is left."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        buf, off = text_bytes(texts)
        buf = _LOWER[buf]
        solid = np.zeros(len(buf) + 2, bool)
        solid[1:-1] = ~_BLANK[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[off] = True
        starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
        ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
        stops = np.searchsorted(np.flatnonzero(_STOP[buf]), starts)  # signs that end a piece, before each word
        text = np.searchsorted(off, starts, side="right") - 1
        n = len(starts)
        new = np.ones(n + 1, bool)  # where a piece begins, and the end
        new[1:-1] = (stops[1:] != stops[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        self.left = np.repeat(at[1:], np.diff(at)) - np.arange(n)
        upto = np.zeros(n + 1, np.int64)
        np.cumsum(ends - starts, out=upto[1:])
        words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(upto), pa.py_buffer(buf[solid[1:-1]])])
        words = words.dictionary_encode()
        order = pc.sort_indices(words.dictionary)
        self.words = words.dictionary.take(order)
        rank = np.empty(len(order), np.int32)
        rank[order.to_numpy()] = np.arange(1, len(order) + 1)
        self.rank = rank[words.indices.to_numpy(zero_copy_only=False)]
        langs = pc.fill_null(langs.cast(pa.string()), "und").dictionary_encode()
        order = pc.sort_indices(langs.dictionary.cast(pa.binary()))
        self.langs = langs.dictionary.take(order).to_pylist()
        place = np.empty(len(order), np.int32)
        place[order.to_numpy()] = np.arange(len(order))
        self.lang = place[langs.indices.to_numpy(zero_copy_only=False)][text]

    def column(self, depth: int) -> np.ndarray:
        """The rank of the word ``depth`` words behind each one, 0 if its piece has ended."""
        out = np.zeros(len(self.rank), np.int32)
        out[:max(0, len(out) - depth)] = self.rank[depth:]
        return np.where(self.left > depth, out, 0)

    def distinct(self, longest: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """(language, words, number) of each distinct suffix of up to ``longest`` words, in order."""
        bits = max(len(self.words), len(self.langs)).bit_length()
        columns = [self.lang, *(self.column(d) for d in range(longest))]
        keys, used = [], 64
        for c in columns:  # as few sort keys as hold all columns
            if used + bits > 62:
                keys.append(c.astype(np.int64))
                used = bits
            else:
                keys[-1] = keys[-1] << bits | c
                used += bits
        order = np.lexsort(keys[::-1])
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys]) if len(order) else False
        heads = np.flatnonzero(new)
        at = order[heads]
        return self.lang[at], [c[at] for c in columns[1:]], np.diff(heads, append=len(order))


def _narrowed(column: np.ndarray, lo: int, hi: int, value: int) -> tuple[int, int]:
    part = column[lo:hi]
    return lo + int(np.searchsorted(part, value)), lo + int(np.searchsorted(part, value, side="right"))


def places(bounds: list[tuple], langs: list[str], words: list[bytes], lang: np.ndarray, columns: list[np.ndarray]) -> list[int]:
    """How many of the sorted suffixes are below each of the bounds (language, words)."""
    from bisect import bisect_left

    out = []
    raw = [x.encode() for x in langs]
    for its_lang, its_words in bounds:
        i = bisect_left(raw, its_lang)
        lo, hi = _narrowed(lang, 0, len(lang), i)
        known = i < len(raw) and raw[i] == its_lang
        for d, column in enumerate(columns):
            if not known or lo == hi:
                break
            if d >= len(its_words):
                hi = _narrowed(column, lo, hi, 0)[1]
                continue
            i = bisect_left(words, its_words[d])
            known = i < len(words) and words[i] == its_words[d]
            a, b = _narrowed(column, lo, hi, i + 1)
            lo, hi = (a, b) if known else (a, a)
        out.append(lo)
    return out


def _packed(columns: list[np.ndarray], number: np.ndarray, words: pa.Array) -> tuple[bytes, int]:
    """Suffixes and the words they use, compressed, and the size before."""
    used, local = np.unique(np.concatenate(columns), return_inverse=True)
    own = as_bytes(words.take(pa.array(used[used > 0] - 1)))
    local = local + (0 if len(used) and used[0] == 0 else 1)
    kind, weigh = np.min_scalar_type(len(used) + 1), np.min_scalar_type(int(number.max()))
    blob = b"\n".join(own)
    head = np.array([len(number), len(blob), kind.itemsize, weigh.itemsize], np.int64).tobytes()
    data = head + blob + local.astype(kind).tobytes() + number.astype(weigh).tobytes()
    return pa.compress(data, codec="zstd", asbytes=True), len(data)


def _unpacked(data: bytes, size: int, longest: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words (from 1), the suffixes as an array of ``longest`` rows, and their numbers."""
    data = pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)
    n, blob, kind, weigh = np.frombuffer(data, np.int64, 4).tolist()
    at = 32 + blob
    columns = np.frombuffer(data, f"u{kind}", n * longest, at).reshape(longest, n)
    return data[32:at].split(b"\n"), columns, np.frombuffer(data, f"u{weigh}", n, at + n * longest * kind).astype(np.int64)


def frequent_prefixes(columns: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to suffixes, whose words are the columns of
    ``columns`` (0 for none): (depth, a pointer to each frequent prefix's suffixes, their weight).

    All live partitions are parted together: by the word at its depth each element is below, at
    or above its partition's pivot, and moves to its place by running counts of the three.
    """
    longest, n = columns.shape
    flat = columns.ravel()
    ptr = np.arange(n, dtype=np.int32)
    begin, depth = np.zeros(1, np.int64), np.zeros(1, np.int64)  # of each live partition
    if n == 0 or weight.sum() < least:
        return
    while len(ptr):
        size = np.diff(begin, append=len(ptr))
        part = np.repeat(np.arange(len(begin), dtype=np.int32), size)
        key = flat[(depth * n)[part] + ptr]
        # the median of three
        a, b, c = key[begin], key[begin + size // 2], key[begin + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[part]
        side = (key >= pivot).astype(np.int8) + (key > pivot)
        slot = 3 * part + side  # 32 bits
        count = np.bincount(slot, minlength=3 * len(begin))
        first = np.cumsum(count) - count
        place = np.empty(len(ptr), np.int32)
        for s in range(3):
            own = np.flatnonzero(side == s)
            # elements of one side keep their order: the nth of its partition goes to first + n
            its = slot[own]
            nth = np.arange(len(own))
            heads = np.ones(len(own), bool)
            heads[1:] = its[1:] != its[:-1]
            base = np.maximum.accumulate(np.where(heads, nth, 0))
            place[own] = first[its] + nth - base
        moved = np.empty_like(ptr)
        moved[place] = ptr
        ptr = moved
        upto = np.zeros(len(ptr) + 1, np.int64)
        np.cumsum(weight[ptr], out=upto[1:])
        total = upto[first + count] - upto[first]
        live = total >= least
        equal = np.arange(len(count)) % 3 == 1
        of = np.repeat(depth, 3)
        ends = np.zeros(len(count), bool)  # equal partitions of suffixes that have ended
        some = np.flatnonzero(equal & (count > 0))
        ends[some] = flat[of[some] * n + ptr[first[some]]] == 0
        live &= ~ends
        found = np.flatnonzero(live & equal)
        for d in np.unique(of[found]).tolist():
            mine = found[of[found] == d]
            yield d, ptr[first[mine]], total[mine]
        live &= ~equal | (of + 1 < longest)
        keep = np.repeat(live, count)
        ptr = ptr[keep]
        sizes = count[live]
        begin, depth = np.cumsum(sizes) - sizes, (of + equal)[live]


def _bounds(docs: DataFrame, longest: int, span: int) -> list[tuple[bytes, list[bytes]]]:
    """Where the order of all suffixes is cut into ranges of about ``span``."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=CHUNK_BYTES):
                s = Suffixes(part.column("text"), part.column("lang"))
                n = len(s.rank)
                at = np.unique(np.linspace(0, n - 1, min(n, PICKS)).astype(int))
                words = [[s.words[int(s.rank[i + d]) - 1].as_py().decode() for d in range(min(longest, int(s.left[i])))] for i in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s.langs[s.lang[i]] for i in at], pa.string()), pa.array(words, pa.list_(pa.string())),
                     pa.array([n if k == 0 else 0 for k in range(len(at))], pa.int64())], names=["lang", "words", "n"])

    picked = stored(docs.mapInArrow(pick, "lang string, words array<string>, n bigint"), "phrase_sample")
    ranges = -(-(picked.agg(F.sum("n")).first()[0] or 0) // span)
    if ranges < 2:
        return []
    some = picked.orderBy(F.xxhash64("lang", "words"), "lang", "words").limit(min(MOST_PICKS, PICKS_A_RANGE * ranges)).collect()
    some = sorted((r.lang.encode(), [w.encode() for w in r.words]) for r in some)
    cuts = [some[len(some) * i // ranges] for i in range(1, ranges)]
    return [c for c, before in zip(cuts, [None, *cuts]) if c != before]


def count_phrases(docs: DataFrame, longest: int = 4, least: int = 30, span: int | None = None) -> DataFrame:
    """``docs`` (text, lang) -> ``lang``, ``k`` (words), ``phrase``, ``f`` (occurrences) of every phrase
    of 1 to ``longest`` words that occurs ``least`` times or more, and with ``k`` 0 the number of
    all words of a language. ``span`` is the number of suffixes in a range, about."""
    docs = docs.select("text", F.col("lang").cast("string").alias("lang"))
    bounds = _bounds(docs, longest, span or RANGE)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=CHUNK_BYTES):
                s = Suffixes(part.column("text"), part.column("lang"))
                lang, columns, number = s.distinct(longest)
                cuts = places(bounds, s.langs, as_bytes(s.words) if bounds else [], lang, columns)
                heads = np.flatnonzero(np.diff(lang, prepend=-1)).tolist()
                cuts = [0, *cuts, len(lang)]
                rows = []
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    steps = [a, *(h for h in heads if a < h < b), b]
                    for x, y in zip(steps, steps[1:]):
                        if x < y:
                            rows.append((i, s.langs[lang[x]], *_packed([c[x:y] for c in columns], number[x:y], s.words)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.binary(), pa.int64()))],
                        names=["part", "lang", "data", "size"])

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        out = [x for lang, own in rows.groupby("lang", sort=False)
               for x in _counted(lang, list(zip(own["data"], own["size"])), longest, least)]
        return pd.DataFrame(out, columns=["lang", "k", "phrase", "f"])

    sent = docs.mapInArrow(send, "part int, lang string, data binary, size bigint")
    found = sent.groupBy("part").applyInPandas(sort, "lang string, k int, phrase string, f bigint")
    return stored(found.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).filter(f"f >= {least} OR k = 0"), "phrases")


def _counted(lang: str, messages: list[tuple[bytes, int]], longest: int, least: int) -> Iterator[tuple]:
    """Rows (language, words, phrase, count) of one language's part of a range."""
    parts, weights, words, first, last = [], [], [], None, None
    for data, size in messages:
        its, columns, number = _unpacked(data, size, longest)
        ends = [[its[c - 1] for c in columns[:, i].tolist() if c] for i in (0, -1)]
        first, last = min(first or ends[0], ends[0]), max(last or ends[1], ends[1])
        words.append(pa.array(its, pa.large_binary()))
        parts.append(columns)
        weights.append(number)
    every = pa.chunked_array(words).combine_chunks().dictionary_encode()
    code = np.append(every.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1, np.int32(0))
    base, rows = 0, np.empty((longest, sum(len(x) for x in weights)), np.int32)
    at = 0
    for own, columns in zip(words, parts):
        local = columns.astype(np.int64) + (base - 1)
        local[columns == 0] = len(code) - 1
        rows[:, at:at + columns.shape[1]] = code[local]
        base += len(own)
        at += columns.shape[1]
    weight = np.concatenate(weights)
    yield lang, 0, "", int(weight.sum())
    ends = {*first, *last}
    number_of = {w: i + 1 for i, w in enumerate(as_bytes(every.dictionary)) if w in ends}
    edges = {tuple(number_of[w] for w in x[:d]) for x in (first, last) for d in range(1, len(x) + 1)}
    text = lambda codes: b" ".join(every.dictionary[c - 1].as_py() for c in codes).decode()
    for codes in edges:  # these may go on in other ranges
        same = np.ones(len(weight), bool)
        for d, c in enumerate(codes):
            same &= rows[d] == c
        yield lang, len(codes), text(codes), int(weight[same].sum())
    for d, at, total in frequent_prefixes(rows, weight, least):
        for codes, f in zip(map(tuple, rows[:d + 1, at].T.tolist()), total.tolist()):
            if codes not in edges:
                yield lang, d + 1, text(codes), f


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, contained: int = 80, top: int = 2000,
                 span: int | None = None) -> DataFrame:
    """``docs`` (text, lang) -> ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of each
    language's best phrases.

    A phrase of 2 to ``longest`` words that occurs ``least`` times or more is a candidate. Each cut
    into two parts scores 2,000,000 * a / (l + r), floored, and the worst cut counts. Candidates
    inside a longer one with at least ``contained`` percent of their occurrences are dropped.
    """
    phrases = count_phrases(docs, longest, least, span)
    number = phrases.filter("k = 0").select("lang", F.col("f").alias("n"))
    known = phrases.filter("k > 0").select("lang", "phrase", "f")
    cands = phrases.filter("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cands.select("lang", "k", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"))
    big = lambda c: F.expr(f"CAST({c} AS DECIMAL(19, 0))")
    scored = (cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
              .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
              .withColumns({"x": F.lit(2_000_000).cast("decimal(7,0)") * big("a"), "y": big("l") + big("r")})
              .withColumn("score", F.expr("x DIV y")))
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    inner = cands.filter("k > 2").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> array_join(slice(w, s, m), ' '))))")
    ).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = worst.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100).cast("decimal(3,0)") * big("longer") < F.lit(contained).cast("decimal(3,0)") * big("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("m.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(number, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "m.l", "m.r", "n", "m.score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
words AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
phrases AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, (VALUES (1), (2), (3), (4)) ks(k) WHERE len(w) >= k)
  GROUP BY lang, k, phrase),
numbers AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
cands AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a // (l.f + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cands) c
  JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM worst c WHERE NOT EXISTS (
    SELECT 1 FROM cands b WHERE b.lang = c.lang AND len(b.w) > len(string_split(c.phrase, ' '))
      AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * b.a >= 80 * c.a))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM kept k JOIN numbers USING (lang))
WHERE rank <= 2000
"""
