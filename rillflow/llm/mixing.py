"""Mixing sources to target weights, by DataFrame functions alone.

Every document gets a hash-random key, from its id and its text. The documents of a source are
put in key order, in ranges of the key: sums per range give, by a prefix sum over the ranges,
the one range where the source's budget ends; in that range sums per key give the one key where
it ends. So no task ever sorts a source, and a source holding a third of all rows costs no more
than the rest. Rows equal in id and text have one key and are interchangeable. Only where a
budget ends among such rows they are numbered, in the tasks that read them, behind the numbers of
the tasks before; so a row that is repeated millions of times is never gathered either.

Rows: a null text has size 0 and is never taken; a null source is a source of its own, the
last one; rows with the same id, text and source are exchangeable, and a row's repeats are
taken one by one; an empty table gives an empty result. Columns of the input named like an
output column (``size``, ``source_size``, ``target``, ``taken``) or starting with ``__mix_``
are replaced by ``mix``; the stage leaves every column as it is, whatever its name. A very long
text is split into words by one expression, about 50 bytes of memory a word in the stage. The
plan has a row per source, which one task puts in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import WORD, set_aside, small_or_not, stored

#: Hex digits of the key that name a range. 65,536 ranges per source: one holds 1/65,536 of it.
RANGE_DIGITS = 4
#: Hex digits that name a group of ranges.
GROUP_DIGITS = 2

ADDED = ("size", "source_size", "target", "taken")


def with_size_and_key(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """Adds ``size`` (words of ``text``) and the columns the mix works on."""
    return docs.drop(*ADDED).withColumns({
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        "__mix_key": F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                                    F.md5(F.coalesce(F.col("text"), F.lit(""))))),
        "__mix_source": F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")),
    })


def source_targets(sized: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source: ``source_size`` and ``target``.

    The sources share ``share`` of all sizes by weight; a target stops at ``most`` times its
    source's size and its excess is shared again by weight until none is above. In the order
    of limit per weight the stopped sources come first, so one pass finds the level at which
    the rest share: what is left over the weight that is left.
    """
    totals = sized.groupBy("__mix_source").agg(F.first("source").alias("source"),
                                               F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(place) - 1) % len(weights))
    t = totals.withColumn("w", weight).withColumn("cap", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    left_w = F.sum("w").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    cap_before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    t = t.withColumns({"n": F.row_number().over(by_level), "total": F.sum("source_size").over(everything),
                       "left_w": left_w, "cap_before": cap_before})
    t = t.withColumn("level", (F.col("total") * F.lit(float(share)) - F.col("cap_before")) / F.col("left_w"))
    t = t.withColumn("over", F.col("level") * F.col("w") > F.col("cap"))
    first_free = F.min(F.when(~F.col("over"), F.struct("n", "level"))).over(everything)
    t = t.withColumn("free", first_free)
    target = F.when(F.col("free").isNull() | (F.col("n") < F.col("free.n")), F.col("cap").cast("double")) \
        .otherwise(F.col("free.level") * F.col("w"))
    return t.select("__mix_source", "source_size", target.alias("target"))


def mix(docs: DataFrame, narrow: DataFrame | None = None, weights=(5, 2, 1), share: float = 1.5,
        most: int = 2) -> DataFrame:
    """``docs`` (from ``with_size_and_key``) with ``source_size``, ``target``, ``taken``.

    Every source's ``taken`` adds up to the whole part of its target: whole epochs, then the
    documents in key order up to the budget, the last of them in part. ``narrow`` is a stored
    copy without the texts, which all passes but the last read.
    """
    cols = ["doc_id", "source", "size", "__mix_key", "__mix_source"]
    narrow = stored(docs.select(*cols), "mix_sizes") if narrow is None else narrow
    plan = source_targets(narrow, weights, share, most)
    quota = F.floor("target")
    plan = plan.withColumns({
        "__mix_epochs": F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0),
    }).withColumn("__mix_rest", F.when(F.col("source_size") > 0, quota - F.col("__mix_epochs") * F.col("source_size"))
                  .otherwise(0).cast("long"))
    plan = stored(plan, "mix_plan")
    key_range = F.substring("__mix_key", 1, RANGE_DIGITS)

    # the range in which each source's budget ends, and what lies before it
    sums = narrow.groupBy("__mix_source", key_range.alias("__mix_range")).agg(F.sum("size").alias("s"))
    # summed up in two levels, so that a source's ranges do not meet in one task either
    sums = sums.withColumn("__mix_group", F.substring("__mix_range", 1, GROUP_DIGITS))
    groups = sums.groupBy("__mix_source", "__mix_group").agg(F.sum("s").alias("all"))
    before = Window.partitionBy("__mix_source").orderBy("__mix_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("__mix_source", "__mix_group", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("far"))
    up_to = Window.partitionBy("__mix_source", "__mix_group").orderBy("__mix_range").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ends = sums.withColumn("near", F.sum("s").over(up_to)).join(groups, ["__mix_source", "__mix_group"]) \
        .withColumn("upto", F.col("near") + F.col("far")).join(plan.select("__mix_source", "__mix_rest"), "__mix_source") \
        .filter((F.col("upto") - F.col("s") < F.col("__mix_rest")) & (F.col("upto") >= F.col("__mix_rest"))) \
        .select("__mix_source", F.col("__mix_range").alias("__mix_end"),
                (F.col("upto") - F.col("s")).alias("__mix_before"))
    # in that range the key at which it ends, and how many rows have it
    keys = narrow.withColumn("__mix_range", key_range).join(
        ends.select("__mix_source", F.col("__mix_end").alias("__mix_range"), "__mix_before"), ["__mix_source", "__mix_range"]) \
        .groupBy("__mix_source", "__mix_before", "__mix_key").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("__mix_equal"))
    in_order = Window.partitionBy("__mix_source").orderBy("__mix_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = keys.withColumn("upto", F.col("__mix_before") + F.sum("s").over(in_order)).join(plan.select("__mix_source", "__mix_rest"), "__mix_source") \
        .filter((F.col("upto") - F.col("s") < F.col("__mix_rest")) & (F.col("upto") >= F.col("__mix_rest"))) \
        .select("__mix_source", F.col("__mix_key").alias("__mix_end"), (F.col("__mix_rest") - F.col("upto") + F.col("s")).alias("__mix_room"), "__mix_equal")
    plan = stored(plan.join(last, "__mix_source", "left"), "mix_ends")

    planned = docs.withColumn("__mix_id", F.monotonically_increasing_id()).join(small_or_not(plan), "__mix_source")
    whole = F.col("__mix_epochs") * F.col("size")
    at_end = F.coalesce(F.col("__mix_key") == F.col("__mix_end"), F.lit(False))
    before_end = F.when(F.coalesce(F.col("__mix_key") < F.col("__mix_end"), F.lit(False)), F.col("size")).otherwise(0)
    part = lambda nth: F.least(F.greatest(F.col("__mix_room") - nth * F.col("size"), F.lit(0)), F.col("size"))
    one = planned if plan.filter("__mix_equal > 1").isEmpty() else planned.filter(~(at_end & (F.col("__mix_equal") > 1)))
    out = one.withColumn("taken", whole + F.when(at_end, part(F.lit(0))).otherwise(before_end))
    if one is not planned:
        out = out.unionByName(_numbered(planned.filter(at_end & (F.col("__mix_equal") > 1))).withColumn(
            "taken", whole + part(F.col("__mix_nth"))).drop("__mix_nth"))
    return out.withColumn("taken", F.col("taken").cast("long")).drop(*[c for c in out.columns if c.startswith("__mix_")])


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__mix_nth``, their number within their source from 0: within each part of the input
    by ``__mix_id``, behind the rows of the parts before."""
    rows = rows.withColumn("__mix_in", F.shiftright("__mix_id", 33))
    parts = rows.groupBy("__mix_source", "__mix_in").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("__mix_source").orderBy("__mix_in").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__mix_source", "__mix_in", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__mix_first"))
    inside = Window.partitionBy("__mix_source", "__mix_in").orderBy("__mix_id")
    numbered = rows.withColumn("__mix_place", F.row_number().over(inside) - 1).join(parts, ["__mix_source", "__mix_in"])
    return numbered.withColumn("__mix_nth", F.col("__mix_first") + F.col("__mix_place")).drop("__mix_in", "__mix_first", "__mix_place")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document's share in the mix: doc_id, size, source_size, target, taken."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    sized = stored(with_size_and_key(docs).drop("text"), "mix_sizes")
    return mix(sized, narrow=sized).select("doc_id", "size", "source_size", "target", "taken")


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the mix takes them: one row per epoch, the row at the
    end of a source's budget cut after its last word that still fits; columns as given."""
    given, names = set_aside(docs, ("doc_id", "text", "source", "n_chars"))
    taken = mix(with_size_and_key(given))
    parts = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    rows = taken.filter("taken > 0").withColumn("__mix_part", F.explode(parts))
    left = (F.col("taken") - (F.col("__mix_part") - 1) * F.col("size")).cast("int")
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), left), "")
    text = F.when(left < F.col("size"), cut).otherwise(F.col("text"))
    rows = rows.withColumn("__mix_cut", left < F.col("size")).withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__mix_cut"), F.length("text").cast("long"))
                               .otherwise(F.col("n_chars")))
    return rows.select(*names).toDF(*docs.columns)


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2 * source_size AS cap,
         row_number() OVER o AS n,
         (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
            - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(w) OVER (ORDER BY 2 * source_size / w, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM totals WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST)),
free AS (SELECT min(n) AS n, arg_min(level, n) AS level FROM levels WHERE NOT level * w > cap),
plan AS (
  SELECT source, source_size,
         CASE WHEN free.n IS NULL OR levels.n < free.n THEN CAST(cap AS DOUBLE) ELSE free.level * w END AS target
  FROM levels, free),
quota AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM plan),
ordered AS (
  SELECT s.doc_id, s.size, q.source_size, q.target, q.epochs,
         CAST(floor(q.target) AS BIGINT) - q.epochs * q.source_size
           - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id NULLS FIRST, s.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM sized s JOIN quota q ON s.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(greatest(room, 0), size) AS BIGINT) AS taken
FROM ordered
"""
