"""Tables from changelogs: latest value per key, deletes, filters on a table.

A changelog row ``(key, value..., order...)`` with all values null is a delete
(tombstone). The table is the latest row per key by the order columns; a key whose
latest row is a delete is absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cs):
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that have a key: a keyed grouping, window, table or state skips the others."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def latest_per_key(changelog: DataFrame, key: str | list[str], value_cols: list[str],
                   order_cols: list[str], keep_deletes: bool = False,
                   tombstone: Column | None = None, null_keys: bool = False) -> DataFrame:
    """The table a changelog describes: one row per key with its latest values.

    ``tombstone`` marks delete rows (default: every value column null). Deletes win when they are
    latest and the key is dropped, unless ``keep_deletes`` (then the row is kept with
    ``__deleted`` true). A record without a key has no table row, unless ``null_keys``, for
    tables whose rows are groups. The order columns must be unique within a key (an offset
    or event id last), or ties are broken arbitrarily.

    Runs as one ``groupBy(key)`` with ``max_by(values, order)``: partial aggregation on the map
    side keeps a hot key from landing whole in one task, and only one row per key per partition
    crosses the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if tombstone is None:
        tombstone = F.lit(True)
        for c in value_cols:
            tombstone = tombstone & F.col(c).isNull()
    if not null_keys:
        changelog = keyed(changelog, *keys)
    latest = (changelog.groupBy(*keys)
              .agg(F.max_by(F.struct(*_cols(value_cols), tombstone.alias("__tomb")),
                            F.struct(*_cols(order_cols))).alias("__latest")))
    out = latest.select(*keys, *[F.col(f"__latest.{c}").alias(c) for c in value_cols],
                        F.col("__latest.__tomb").alias("__tomb"))
    if keep_deletes:
        return out.withColumnRenamed("__tomb", "__deleted")
    return out.filter(~F.col("__tomb")).drop("__tomb")


def filter_table(table: DataFrame, condition: Column) -> DataFrame:
    """Filter applied to a table (after latest-per-key): a key whose latest value no
    longer passes is gone, as a delete would remove it. Conditions on the key alone are
    pushed below the aggregation by Catalyst; conditions on values stay above it."""
    return table.filter(condition)
