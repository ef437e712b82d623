"""The two-level (bucketed) operators against plain Python on random inputs with a hot
key, ties and deletes, using small buckets so carries cross many bucket edges."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from helpers import rows
from rillflow.operators.joins import asof_join
from rillflow.operators.running import running_sum
from rillflow.operators.windows import session_count

T0 = datetime(2024, 1, 1)


def _events(rnd, n, keys, span):
    # key 0 is hot: about a third of all rows
    return [(0 if rnd.random() < 0.34 else rnd.randint(1, keys), i,
             T0 + timedelta(seconds=rnd.randint(0, span))) for i in range(n)]


# widths of the two levels of offset buckets: carries over many edges, and the default
GRIDS = [(2, 4), (3, 10), (16, 28)]


def _log(rnd, n, hot_side):
    """Offsets with (side, key, value); key 0 has a third of the rows, or all of one side's."""
    out = []
    for i in range(n):
        side = rnd.choice(["stream", "stream", "table"])
        key = 0 if rnd.random() < 0.34 or side == hot_side else rnd.randint(1, 4)
        out.append((i * 3, side, key, None if rnd.random() < 0.25 else f"v{i}"))
    return out


@pytest.mark.parametrize("seed,hot_side", [(1, None), (2, "stream"), (3, "table")])
def test_asof_matches_bruteforce(spark, seed, hot_side):
    log = _log(random.Random(seed), 250, hot_side)
    want, table = [], {}
    for i, side, k, v in log:
        if side == "table":
            table[k] = v
        else:
            want.append((i, table.get(k)))
    s = spark.createDataFrame([(k, i) for i, side, k, _ in log if side == "stream"] + [(None, 9000)], "k long, id long")
    c = spark.createDataFrame([(k, i, v) for i, side, k, v in log if side == "table"], "k long, id long, info string")
    for bits in GRIDS:
        got = rows(asof_join(s, c, "k", "id", ["info"], how="left", bits=bits), "id", "info")
        assert got == sorted(want)
        inner = rows(asof_join(s, c, "k", "id", ["info"], bits=bits), "id", "info")
        assert inner == sorted(w for w in want if w[1] is not None)


def test_running_sum_matches_bruteforce(spark):
    rnd = random.Random(3)
    # times in no order: the offset alone counts
    ev = [(k, i, t, None if i % 40 == 7 else round(rnd.uniform(0, 100), 2)) for k, i, t in _events(rnd, 300, 5, 5000)]
    want, have = [], {}
    for k, i, t, a in ev:
        have[k] = have.get(k, Decimal(0)) + (0 if a is None else Decimal(str(a)))
        want.append((i, have[k]))
    df = spark.createDataFrame(ev + [(None, 999, T0, 5.0)], "k long, id long, ts timestamp, amount double")
    for bits in GRIDS:
        got = rows(running_sum(df, "k", "amount", "id", bits=bits), "id", "running_bal")
        assert got == sorted(want)


def test_sessions_match_bruteforce(spark):
    rnd = random.Random(4)
    ev = _events(rnd, 400, 3, 20000)
    want = []
    for k in {e[0] for e in ev}:
        ts = sorted(e[2] for e in ev if e[0] == k)
        start, last, n = ts[0], ts[0], 1
        for t in ts[1:]:
            if t - last > timedelta(seconds=300):
                want.append((k, start, last, n))
                start, n = t, 0
            last, n = t, n + 1
        want.append((k, start, last, n))
    df = spark.createDataFrame(ev, "k long, id long, ts timestamp")
    got = rows(session_count(df, "k", "ts", 300), "k", "window_start", "window_end", "count")
    assert got == sorted(want)


def test_interval_join_on_bucket_edges_and_exact_bounds(spark):
    from rillflow.operators.joins import interval_join
    rnd = random.Random(8)
    w = 300
    # times on bucket edges (multiples of w and 2w) and exactly +-w apart, with a hot key
    pts = [k * w + d for k in range(12) for d in (-1, 0, 1)]
    left = [(0 if rnd.random() < 0.5 else 1, i, T0 + timedelta(seconds=rnd.choice(pts)))
            for i in range(120)]
    right = [(0 if rnd.random() < 0.5 else 1, i, T0 + timedelta(seconds=rnd.choice(pts)))
             for i in range(120)]
    want = sorted((a[1], b[1]) for a in left for b in right
                  if a[0] == b[0] and abs((a[2] - b[2]).total_seconds()) <= w)
    lf = spark.createDataFrame(left, "k long, lid long, lt timestamp")
    rf = spark.createDataFrame(right, "k2 long, rid long, rt timestamp")
    assert rows(interval_join(lf, rf, "k", "k2", "lt", "rt", w), "lid", "rid") == want
