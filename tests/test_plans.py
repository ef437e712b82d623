"""Plan properties the scale design relies on, read from ``explain()``: partial
aggregation before shuffles, top-k without a global sort, windows over bucket summaries
rather than raw rows, pushed filters and pruned scans."""

import contextlib
import io
import re

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"
Q = queries()


def plan(spark, name, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        Q[name](spark, SF).explain(mode)
    return re.sub(r"#\d+L?", "", buf.getvalue())


def read_schemas(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def test_top3_counts_before_join_and_takes_ordered(spark):
    p = plan(spark, "top3_news")
    assert "TakeOrderedAndProject(limit=3" in p
    assert re.search(r"partial_count\(1\).*\n.*\n?.*FileScan parquet \[l_partkey\]", p) or \
        ("partial_count(1)" in p and "[l_partkey]" in p)
    assert "Sort [" not in p  # partial top-k per partition, no global sort


@pytest.mark.parametrize("name", ["word_count", "bank_balance_aggregate", "tumbling_count",
                                  "hopping_count", "favourite_colour"])
def test_partial_aggregation_before_exchange(spark, name):
    p = plan(spark, name)
    assert "partial_" in p


def test_session_window_runs_on_bucket_summaries(spark):
    p = plan(spark, "session_count")
    window_part = p[p.index("Window ["):]
    # below the windows there is an aggregate over (user, bucket), not the raw scan
    assert "partial_min(ts)" in window_part and "partial_count(1)" in window_part


def test_interval_join_keys_on_user_and_bucket(spark):
    p = plan(spark, "recharge_match")
    assert re.search(r"Join \[r_user, __lb\], \[c_user, __rb\]", p)


def test_stock_filter_semi_join_before_aggregate(spark):
    top = plan(spark, "stock_filter").split("\n")
    semi = next(i for i, line in enumerate(top) if "LeftSemi" in line)
    agg = max(i for i, line in enumerate(top) if "max_by" in line)
    assert semi > agg  # below: rows of other keys are gone before the sort and the shuffle


def test_scans_are_pruned_and_filters_pushed(spark):
    p = plan(spark, "purchase_enrich_left")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in p
    for schema in read_schemas(p):
        assert "props" not in schema and "value:" not in schema
    assert read_schemas(plan(spark, "word_count")) == ["text:string"]
    assert read_schemas(plan(spark, "top3_news")) in (
        ["l_partkey:bigint", "p_partkey:bigint,p_type:string"],
        ["p_partkey:bigint,p_type:string", "l_partkey:bigint"])


def _scans(spark, name):
    """File scans of the plan that ran; a reused exchange is not run again."""
    df = Q[name](spark, SF)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text[:text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text
    return len(re.findall(r"FileScan parquet", final)), final


@pytest.mark.parametrize("name,scans", [("running_balance", 1), ("purchase_asof_left", 2), ("favourite_colour", 1)])
def test_one_scan_a_side_and_no_sample(spark, name, scans):
    n, p = _scans(spark, name)
    assert n == scans, p
    assert "Sample" not in p and "TakeOrdered" not in p
