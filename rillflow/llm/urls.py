"""URL filters: rules by host and path, and two character models for the rest.

A rule names a host and the beginning of a path, for the host and all its subdomains; the
longest rule that fits decides. The URLs that rules allow and those that they block each teach
a Markov model of characters of variable order: the chance of a character is its share after the
last ``ORDER`` characters, smoothed by the chance after one character less, and so on down to
no context. A URL without a rule is allowed if its log-likelihood difference, by length, is at
or over a threshold that parts best the rule-decided URLs of a fifth of all hashes, which
the models that set it have not seen.

Counts are exact: a gram, of up to ``ORDER`` + 1 characters, is two numbers of three characters
each, and a stored table has each gram of any URL with its counts among all URLs that rules
decide. Order by order, a gram's chance comes from two joins within that table, on the gram
without its first and without its last character. URLs are then scored in chunks: a chunk's
distinct grams are joined to the table, so that a gram that all URLs have is asked for once a
chunk. What reaches the driver is four totals and the counts by verdict and threshold step.

Rows: a null URL, or one without ``://``, has no host and path and no rule; an empty one scores
0; equal URLs are judged alike; a null ``page_id`` is carried; if the rules decide no URL, or only
allow or only block, all others are allowed; an empty table gives an empty result. Other columns are
not looked at.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.arrowtext import slices
from rillflow.llm.common import stored
from rillflow.llm.letters import code_points

ORDER = 5
#: A character's chance without context has half a character seen for each of 2^BITS.
BITS = 15
#: Pages of a chunk that is scored at once.
CHUNK = 256
#: Weight of the shorter context's chance against the counts, as a number of characters seen.
SMOOTH = 2.0
#: Threshold candidates: differences from -SPREAD to SPREAD per character, in so many steps.
SPREAD, STEPS = 4.0, 800


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case. Path: what follows it up to ``?``, ``#`` or the end. Both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls; ``rules`` has (verdict, host, path)
    and is a list of settings, not of data."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, word).otherwise(verdict)
    return rule, verdict


def _windows(urls: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(URL of each place, its place there, hi, lo): the ``ORDER`` + 1 characters up to each place, or
    all from the URL's first mark on, as two numbers of three characters of 21 bits. A mark is
    1, a character its code point plus 2, so that 0 is none."""
    cps, off = code_points(urls)
    lens = np.diff(off) + 2
    first = np.cumsum(lens) - lens
    chars = np.ones(lens.sum(), np.int64)
    url = np.repeat(np.arange(len(lens)), lens)
    place = np.arange(len(chars)) - first[url]
    chars[(place > 0) & (place < lens[url] - 1)] = cps.astype(np.int64) + 2
    parts = [np.zeros(len(chars), np.int64), np.zeros(len(chars), np.int64)]
    for k in range(ORDER + 1):
        before = np.zeros(len(chars), np.int64)
        before[k:] = chars[:len(chars) - k]
        parts[k // 3] += np.where(place >= k, before, 0) << 21 * (k % 3)
    return url, place, parts[1], parts[0]


def _same(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct row of the columns: (a row that has it, the number of each row)."""
    order = np.lexsort(columns)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _last(size: int) -> tuple[str, str]:
    """SQL of (hi, lo) of a gram's last ``size`` characters."""
    return ("0L", f"lo & {(1 << 21 * size) - 1}L") if size <= 3 else (f"hi & {(1 << 21 * (size - 3)) - 1}L", "lo")


def _first(size: int) -> str:
    """SQL of the first character of a gram of that size, or 0 if it is shorter."""
    return f"(shiftright({'lo' if size <= 3 else 'hi'}, {21 * ((size - 1) % 3)}) & 2097151L)"


#: A gram's counts: among the allowed URLs that a threshold is not set by and that it is, and the blocked ones.
CLASSES = ("allow_seen", "allow_back", "block_seen", "block_back")


def gram_counts(urls: DataFrame) -> DataFrame:
    """``url, verdict, back`` -> each gram of any of the URLs by size, hi and lo, and how often it
    occurs in each of ``CLASSES``, however many grams there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "url"):
                url, _, hi, lo = _windows(part.column("url"))
                kind = part.column("kind").to_numpy(zero_copy_only=False)[url]
                one, number = _same(lo, hi, kind)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (hi[one], lo[one], kind[one], np.bincount(number))],
                                                 names=["hi", "lo", "kind", "n"])

    kind = F.when(F.col("verdict").isNull(), -1).when(F.col("verdict") == "allow", 0).otherwise(2) \
        + F.when(F.col("verdict").isNotNull() & F.col("back"), 1).otherwise(0)
    windows = urls.filter("url IS NOT NULL").select("url", kind.cast("int").alias("kind")) \
        .mapInArrow(run, "hi bigint, lo bigint, kind int, n bigint")

    def sums(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(*(F.sum(c).alias(c) for c in CLASSES))

    whole = sums(windows.select("hi", "lo", *(F.when(F.col("kind") == k, F.col("n")).otherwise(0).alias(c)
                                              for k, c in enumerate(CLASSES))), "hi", "lo")
    ends = ", ".join(f"IF({_first(k)} > 0, struct({k} AS size, {_last(k)[0]} AS hi, {_last(k)[1]} AS lo), NULL)"
                     for k in range(1, ORDER + 2))
    grams = whole.select(F.expr(f"explode(array_compact(array({ends})))").alias("g"), *CLASSES)
    return sums(grams.select("g.*", *CLASSES), "size", "hi", "lo")


def gram_scores(grams: DataFrame, totals: dict[str, int]) -> DataFrame:
    """``hi, lo, seen, whole`` of every gram that ends a place's window: the log ratio of its last
    character's chance among allowed and among blocked URLs, without and with those held back."""
    models = {"allow_seen": CLASSES[:1], "block_seen": CLASSES[2:3], "allow_whole": CLASSES[:2], "block_whole": CLASSES[2:]}
    count = lambda m, of="": sum(F.col(of + c) for c in models[m])
    ratios = [F.log(F.col(f"p_allow_{x}") / F.col(f"p_block_{x}")).alias(x) for x in ("seen", "whole")]
    level, out = None, None
    for size in range(1, ORDER + 2):
        own = grams.filter(F.col("size") == size).drop("size")
        if level is None:
            chance = {m: (count(m) + 0.5) / F.lit(sum(totals[c] for c in models[m]) + 0.5 * (1 << BITS)) for m in models}
        else:
            shorter = level.select(F.col("hi").alias("end_hi"), F.col("lo").alias("end_lo"), *(F.col(f"p_{m}").alias(f"end_{m}") for m in models))
            before = level.select(F.col("hi").alias("before_hi"), F.col("lo").alias("before_lo"), *(F.col(c).alias(f"before_{c}") for c in CLASSES))
            end_hi, end_lo = _last(size - 1)
            own = own.withColumns({
                "end_hi": F.expr(end_hi), "end_lo": F.expr(end_lo), "before_hi": F.expr("shiftright(hi, 21)"),
                "before_lo": F.expr("shiftright(lo, 21) + shiftleft(hi & 2097151L, 42)")})
            own = own.join(shorter, ["end_hi", "end_lo"]).join(before, ["before_hi", "before_lo"])
            chance = {m: (count(m) + SMOOTH * F.col(f"end_{m}")) / (count(m, "before_") + SMOOTH) for m in models}
        level = stored(own.select("hi", "lo", *CLASSES, *(c.alias(f"p_{m}") for m, c in chance.items())), "url_grams")
        if size > 1:
            ends = level if size == ORDER + 1 else level.filter(f"{_first(size)} = 1")
            ends = ends.select("hi", "lo", *ratios)
            out = ends if out is None else out.unionAll(ends)
    return out


def scored_pages(pages: DataFrame, scores: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) -> page_id, url, copies (equal rows are one), seen, difference."""
    chunks = max(1, -(-pages.count() // CHUNK))
    rows = pages.groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("copies")) \
        .withColumn("chunk", F.pmod(F.xxhash64("page_id", "url"), F.lit(chunks)))

    def asked(table: pa.Table) -> pa.Table:
        _, place, hi, lo = _windows(table.column("url").combine_chunks())
        hi, lo = hi[place > 0], lo[place > 0]
        one, _ = _same(lo, hi)
        return pa.table({"chunk": np.full(len(one), table.column("chunk")[0].as_py(), np.int64), "hi": hi[one], "lo": lo[one]})

    def summed(table: pa.Table, answers: pa.Table) -> pa.Table:
        urls = table.column("url").combine_chunks()
        url, place, hi, lo = _windows(urls)
        url, hi, lo = (x[place > 0] for x in (url, hi, lo))
        known = answers.num_rows
        _, number = _same(np.concatenate([answers.column("lo").to_numpy(), lo]), np.concatenate([answers.column("hi").to_numpy(), hi]))
        lens = np.diff(code_points(urls)[1])
        out = {c: table.column(c) for c in ("page_id", "url", "copies")}
        for name, source in (("seen", "seen"), ("difference", "whole")):
            value = np.full(number.max(initial=-1) + 1, np.nan)
            value[number[:known]] = answers.column(source).to_numpy()
            sums = np.bincount(url, value[number[known:]], minlength=table.num_rows)
            out[name] = np.where(lens > 0, sums / (lens + 1), 0.0)
        return pa.table(out)

    windows = rows.select("chunk", "url").groupBy("chunk").applyInArrow(asked, "chunk bigint, hi bigint, lo bigint")
    answers = windows.join(scores, ["hi", "lo"]).select("chunk", "hi", "lo", "seen", "whole")
    kind = f"page_id {pages.schema['page_id'].dataType.simpleString()}"
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        summed, kind + ", url string, copies bigint, seen double, difference double")


def _threshold(back: DataFrame) -> float:
    """The difference that parts best the URLs held back, from their ``verdict, seen, copies``."""
    step = F.greatest(F.least(F.floor((F.col("seen") + SPREAD) * STEPS / (2 * SPREAD)), F.lit(STEPS - 1)), F.lit(0))
    n = {v: np.zeros(STEPS) for v in ("allow", "block")}
    for r in back.groupBy("verdict", step.cast("int").alias("step")).agg(F.sum("copies").alias("n")).collect():
        n[r.verdict][r.step] = r.n
    # the share of each verdict on the wrong side of a threshold between two steps
    miss = np.concatenate([[0], np.cumsum(n["allow"])]) / max(n["allow"].sum(), 1)
    slip = 1 - np.concatenate([[0], np.cumsum(n["block"])]) / max(n["block"].sum(), 1)
    best = np.flatnonzero(miss + slip <= (miss + slip).min() + 1e-12)
    middle = best[np.argmin(np.abs(best - best.mean()))]
    return float(middle * 2 * SPREAD / STEPS - SPREAD)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages`` (page_id, url) -> page_id, url, host, path, rule, verdict, difference."""
    pages = pages.select("page_id", "url")

    def ruled(df: DataFrame) -> DataFrame:
        host, path = host_and_path(F.col("url"))
        df = df.withColumns({"host": host, "path": path})
        rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
        return df.withColumns({"rule": rule, "verdict": verdict})

    names = ["page_id", "url", "host", "path", "rule", "verdict", "difference"]
    back = F.pmod(F.xxhash64("url"), F.lit(5)) == 4
    grams = stored(gram_counts(ruled(pages).select("url", "verdict", back.alias("back"))), "url_grams")
    totals = {c: n or 0 for c, n in grams.filter("size = 1").agg(*(F.sum(c).alias(c) for c in CLASSES)).first().asDict().items()}
    if not totals["allow_seen"] + totals["allow_back"] or not totals["block_seen"] + totals["block_back"]:
        return ruled(pages).withColumns({"verdict": F.coalesce("verdict", F.lit("allow")), "difference": F.lit(0.0)}).select(names)
    scored = stored(scored_pages(pages, gram_scores(grams, totals)), "url_scores")
    threshold = _threshold(ruled(scored).filter(back & F.col("verdict").isNotNull())) if all(totals.values()) else 0.0
    own = F.when(F.col("difference") >= threshold, "allow").otherwise("block")
    out = ruled(scored).withColumn("verdict", F.coalesce("verdict", own))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(names)


#: The rules: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op8_url_filters(spark, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")
