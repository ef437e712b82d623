"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print
one JSON line with seconds per query (median of the timed runs after one warm-up).

Each run materialises the full result with a ``noop`` write, so every row is computed
without moving results to the driver. ``value`` sums the batch queries' medians; the
``streams`` entry reports three streaming queries (one file per trigger) with wall time,
input rows/s over their data batches and state rows, from ``query.recentProgress``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from rillflow.functions.time import as_event_time, money  # noqa: E402
from rillflow.operators.windows import tumbling_count  # noqa: E402
from rillflow.plans import all_queries  # noqa: E402
from rillflow.plans.enrich import recharge_match  # noqa: E402
from rillflow.session import local_session  # noqa: E402
from rillflow.sources.tables import EVENTS_SCHEMA, event_stream, stream_path  # noqa: E402
from rillflow.streaming import stateful as S  # noqa: E402
from rillflow.streaming.runner import run_stream  # noqa: E402

HEADLINE = [
    "top3_news", "word_count", "favourite_colour", "bank_balance_aggregate",
    "tumbling_count", "hopping_count", "session_count", "recharge_match",
    "purchase_enrich_left", "purchase_asof_left", "latest_login", "stock_filter",
    "running_balance", "topic_inspect",
]


#: Registered streams that are timed as they are, once: three micro-batches each, the writing of
#: their input included.
REGISTERED_STREAMS = ["latest_login_stream", "favourite_colour_stream", "purchase_asof_left_stream",
                      "stock_filter_stream", "session_count_live", "bank_balance_stream",
                      "purchase_enrich_refresh_stream", "top3_news_changes_stream", "colour_totals_stream",
                      "purchase_refresh_changelog_stream", "running_balance_through_topic", "bank_balance_fold_stream"]


def _events(spark, sf_dir):
    return event_stream(spark, stream_path(sf_dir, "events"), EVENTS_SCHEMA,
                        max_files_per_trigger=1)


def _tumbling(spark, sf_dir):
    return tumbling_count(_events(spark, sf_dir), "user_id", "ts", "30 seconds",
                          grace="2 minutes")


def _running(spark, sf_dir):
    S.use_rocksdb_state(spark)
    ev = _events(spark, sf_dir).select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"),
        as_event_time("ts").alias("ts"), (money("value") * 100).cast("long").alias("cents"))
    return S.running_balance(ev)


def _recharge(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")) \
        .withWatermark("ts", "24 hours")

    def side(t):
        return ev.filter(F.col("event_type") == t).select(
            F.col("user_id").alias("user"), F.col("event_id").alias("id"), "ts",
            F.col("props").alias("otp"))
    return recharge_match(side("click"), side("purchase"))


STREAMS = {"tumbling_count_stream": _tumbling, "running_balance_stream": _running,
           "recharge_match_stream": _recharge}


def run_streams(spark, sf_dir, names):
    """Each stream once (after a warm-up run): wall seconds, input rows/s over its data
    batches, and state rows at the end, from ``query.recentProgress``."""
    out = {}
    for name in names:
        run_stream(spark, STREAMS[name](spark, sf_dir), "bench-" + name).wait()
        t0 = time.perf_counter()
        run = run_stream(spark, STREAMS[name](spark, sf_dir), "bench-" + name).wait()
        sec = time.perf_counter() - t0
        prog = [p for p in run.query.recentProgress if p["numInputRows"] > 0]
        rows = sum(p["numInputRows"] for p in prog)
        busy = sum(p["durationMs"].get("triggerExecution", 0) for p in prog) / 1000.0
        last = run.query.recentProgress[-1] if run.query.recentProgress else {}
        state = sum(o.get("numRowsTotal", 0) for o in last.get("stateOperators", []))
        out[name] = {"sec": round(sec, 4), "input_rows": rows,
                     "rows_per_sec": round(rows / busy, 1) if busy else None,
                     "state_rows": state}
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app_name="rillflow-bench")
    q = all_queries()
    times = {}
    for name in names:
        fn = q[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        ts = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(ts), 4)
    stream_names = [n for n in os.environ.get("BENCH_STREAMS", ",".join(STREAMS)).split(",") if n]
    streams = run_streams(spark, sf_dir, stream_names)
    for name in [n for n in os.environ.get("BENCH_REGISTERED", ",".join(REGISTERED_STREAMS)).split(",") if n]:
        t0 = time.perf_counter()
        q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        streams[name] = {"sec": round(time.perf_counter() - t0, 4)}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(times.values()), 4), "unit": "sec",
                      "queries": times, "streams": streams, "sf": sf, "cpus": cpus,
                      "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
