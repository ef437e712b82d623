"""Golden rows from the reference programs' demo inputs (FIXTURES.md sections 3-4)."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from rillflow.functions.jsonio import decode_json, encode_json, parse_json
from rillflow.functions.text import java_split_words
from rillflow.operators.aggregates import balance_fold, balance_reduce
from rillflow.operators.joins import asof_join, interval_join, snapshot_lookup
from rillflow.operators.running import running_sum
from rillflow.operators.windows import hopping_count, session_count, tumbling_count
from rillflow.plans.counting import favourite_colour, word_count
from rillflow.plans.enrich import enriched_text, recharge_match
from rillflow.plans.ranking import top3_news, top3_sorted
from rillflow.plans.table_ops import stock_filter

T0 = datetime(2024, 1, 1)


def test_word_count(spark):
    lines = spark.createDataFrame(
        [("kafka streams udemy",), ("kafka data processing",), ("kafka streams course",)],
        "text string")
    assert dict(rows(word_count(lines), "word", "count")) == {
        "kafka": 3, "streams": 2, "udemy": 1, "data": 1, "processing": 1, "course": 1}


def test_java_split_rules(spark):
    df = spark.createDataFrame([("",), ("!!!",), (" Hi, x! ",), (None,)], "text string")
    got = [r[0] for r in df.select(java_split_words("text")).collect()]
    assert got == [[""], [], ["", "hi", "x"], None]


def test_favourite_colour_keeps_zero(spark):
    ch = spark.createDataFrame(
        [("stephane", "blue", 1), ("john", "green", 2), ("stephane", "red", 3), ("alice", "red", 4),
         (None, "red", 5)],  # a record without a key has no table row
        "user string, colour string, seq long")
    got = dict(rows(favourite_colour(ch, "user", "colour", "seq"), "colour", "count"))
    assert got == {"red": 2, "green": 1, "blue": 0}


def _bank(spark):
    data = []
    for x in range(1, 51):
        for name, mult in (("divya", 2), ("roshan", 1), ("shubham", 3)):
            data.append((name, mult * x, T0 + timedelta(seconds=x)))
    return spark.createDataFrame(data, "name string, amount int, time timestamp")


def test_bank_balance_fold_and_reduce(spark):
    df = _bank(spark)
    last = T0 + timedelta(seconds=50)
    want = [("divya", 50, Decimal("2550.00"), last), ("roshan", 50, Decimal("1275.00"), last),
            ("shubham", 50, Decimal("3825.00"), last)]
    for fn in (balance_fold, balance_reduce):
        got = rows(fn(df, "name", "amount", "time"), "name", "count", "balance", "time")
        assert got == want


def test_running_balance(spark):
    data = [(n, m * x, T0 + timedelta(seconds=x), i)
            for i, (x, n, m) in enumerate((x, n, m) for x in (1, 2, 3)
                                          for n, m in (("divya", 2), ("roshan", 1), ("shubham", 3)))]
    df = spark.createDataFrame(data, "name string, amount int, time timestamp, id long")
    got = running_sum(df, "name", "amount", "id", bits=(1, 2))
    by = {}
    for n, t, b in rows(got, "name", "time", "running_bal"):
        by.setdefault(n, []).append(int(b))
    assert by == {"divya": [2, 6, 12], "roshan": [1, 3, 6], "shubham": [3, 9, 18]}


def _burst(spark):
    data = []
    for n in ("a", "b", "c"):
        data += [(n, T0), (n, T0), (n, T0 + timedelta(seconds=40))]
    return spark.createDataFrame(data, "name string, ts timestamp")


def test_tumbling(spark):
    got = rows(tumbling_count(_burst(spark), "name", "ts", "30 seconds"),
               "name", "window_start", "count")
    assert [g for g in got if g[0] == "a"] == [("a", T0, 2), ("a", T0 + timedelta(seconds=30), 1)]
    assert len(got) == 6


def test_hopping(spark):
    got = rows(hopping_count(_burst(spark), "name", "ts", "30 seconds", "15 seconds"),
               "name", "window_start", "count")
    s = lambda k: T0 + timedelta(seconds=k)
    assert [g[1:] for g in got if g[0] == "a"] == [(s(-15), 2), (s(0), 2), (s(15), 1), (s(30), 1)]


def test_sessions(spark):
    data, t = [], T0
    for _ in range(3):
        data += [("user_101", t)] * 3 + [("user_102", t)]
        t += timedelta(seconds=40)
    df = spark.createDataFrame(data, "user string, ts timestamp")
    got = rows(session_count(df, "user", "ts", 300), "user", "count")
    assert got == [("user_101", 9), ("user_102", 3)]


def test_session_gap_inclusive(spark):
    df = spark.createDataFrame(
        [("u", T0), ("u", T0 + timedelta(minutes=5)),
         ("u", T0 + timedelta(minutes=10, milliseconds=1))], "user string, ts timestamp")
    got = rows(session_count(df, "user", "ts", 300), "window_start", "window_end", "count")
    assert got == [(T0, T0 + timedelta(minutes=5), 2),
                   (T0 + timedelta(minutes=10, milliseconds=1),
                    T0 + timedelta(minutes=10, milliseconds=1), 1)]


def test_session_spans_many_buckets(spark):
    # one long session (every 4 min for 2 h) and a hot key split over many buckets
    df = spark.createDataFrame([("u", T0 + timedelta(minutes=4 * i)) for i in range(30)],
                               "user string, ts timestamp")
    got = rows(session_count(df, "user", "ts", 300), "window_start", "count")
    assert got == [(T0, 30)]


PURCHASE_LOG = [
    (1, "table", "roshan", "first=roshan, last=soni"),
    (2, "purchase", "roshan", "rapple(1)"),
    (3, "purchase", "divya", "dbanana(2)"),
    (4, "table", "roshan", "first=roshan, last=sonyy"),
    (5, "purchase", "roshan", "rorange(3)"),
    (6, "purchase", "shubham", "sgrapes(4)"),
    (7, "table", "shubham", "first=shubham, last=soni"),
    (8, "purchase", "shubham", "scherry(5)"),
    (9, "table", "shubham", None),
    (10, "table", "deepa", "first=deepa, last=soni"),
    (11, "table", "deepa", None),
    (12, "purchase", "deepa", "deepomo(6)"),
]


def _purchase_frames(spark):
    log = spark.createDataFrame(PURCHASE_LOG, "seq long, topic string, user string, value string")
    log = log.withColumn("ts", F.timestamp_seconds("seq"))
    purchases = log.filter("topic = 'purchase'").select("user", "ts", "seq",
                                                        F.col("value").alias("purchase"))
    table = log.filter("topic = 'table'").select("user", "ts", "seq", F.col("value").alias("info"))
    return purchases, table


def test_purchases_asof(spark):
    purchases, table = _purchase_frames(spark)
    inner = asof_join(purchases, table, "user", "seq", ["info"], bits=(1, 3))
    left = asof_join(purchases, table, "user", "seq", ["info"], bits=(1, 3), how="left")
    assert rows(inner, "purchase", "info") == [
        ("rapple(1)", "first=roshan, last=soni"), ("rorange(3)", "first=roshan, last=sonyy"),
        ("scherry(5)", "first=shubham, last=soni")]
    assert len(left.collect()) == 6
    text = left.select(enriched_text(F.col("purchase"), F.col("info")).alias("t"))
    assert "purchase dbanana(2) info=null" in [r.t for r in text.collect()]


def test_purchases_snapshot(spark):
    purchases, table = _purchase_frames(spark)
    kw = dict(value_cols=["info"], order_cols=["seq"])
    inner = snapshot_lookup(purchases, table.withColumnRenamed("user", "u"), "user", "u", **kw)
    left = snapshot_lookup(purchases, table.withColumnRenamed("user", "u"), "user", "u",
                           how="left", **kw)
    assert rows(inner, "purchase", "info") == [
        ("rapple(1)", "first=roshan, last=sonyy"), ("rorange(3)", "first=roshan, last=sonyy")]
    assert len(left.collect()) == 6


def test_recharge(spark):
    req = spark.createDataFrame([("u1", 1, T0, "11")], "user string, id long, ts timestamp, otp string")
    conf = spark.createDataFrame(
        [("u1", 2, T0 + timedelta(seconds=300), "11"), ("u1", 3, T0 + timedelta(seconds=60), "12"),
         ("u1", 4, T0 + timedelta(seconds=301), "11")], "user string, id long, ts timestamp, otp string")
    got = rows(recharge_match(req, conf), "confirm_id", "result")
    assert got == [(2, "success"), (3, "fail")]


def test_interval_join_bucket_edges(spark):
    # pairs across bucket edges, both ends inclusive, compared with a brute-force test
    import random
    rnd = random.Random(7)
    left = [(rnd.randint(1, 3), i, T0 + timedelta(seconds=rnd.randint(0, 3000))) for i in range(80)]
    right = [(rnd.randint(1, 3), i, T0 + timedelta(seconds=rnd.randint(0, 3000))) for i in range(80)]
    want = sorted((a[1], b[1]) for a in left for b in right
                  if a[0] == b[0] and abs((a[2] - b[2]).total_seconds()) <= 300)
    lf = spark.createDataFrame(left, "k long, lid long, lt timestamp")
    rf = spark.createDataFrame(right, "k2 long, rid long, rt timestamp")
    got = rows(interval_join(lf, rf, "k", "k2", "lt", "rt", 300), "lid", "rid")
    assert got == want


def test_stock_filter(spark):
    ch = spark.createDataFrame(
        [("HDFC", "10", 1), ("HDFC", "", 2), ("AXIS", "5", 3), ("SBI", "7", 4), ("AXIS", None, 5)],
        "sym string, value string, seq long")
    assert stock_filter(ch, "sym", "value", ["seq"], keep_keys=("HDFC", "AXIS")).count() == 0
    watch = spark.createDataFrame([("HDFC",), ("AXIS",), ("SBI",)], "sym string")
    assert rows(stock_filter(ch, "sym", "value", ["seq"], keep_keys=watch), "sym") == [("SBI",)]


def test_top3_tie_and_json(spark):
    clicks = spark.createDataFrame([(t,) for t in "abcd" for _ in range(5)], "inv string")
    inv = spark.createDataFrame([(t, t) for t in "abcd"], "id string, type string")
    got = top3_news(clicks, inv, "inv", "id", "type")
    assert [r.news_type for r in got.collect()] == ["a", "b", "c"]
    counts = spark.createDataFrame([("a", 1), ("b", 7), ("c", 7), ("d", 2)],
                                   "news_type string, clicks long")
    js = top3_sorted(counts).first().top3_sorted
    assert js == ('[{"NewsType":"b","Clicks":7},{"NewsType":"c","Clicks":7},'
                  '{"NewsType":"d","Clicks":2}]')


def test_json_dead_letter_and_lenient_ints(spark):
    df = spark.createDataFrame(
        [(1, '{"name":"a","amount":5}'), (2, "not json"), (3, '{"name":"b","amount":"x"}'),
         (4, '{"name":"c"}'), (5, '{"name":"d","amount":"7"}'), (6, None)],
        "id long, value string")
    schema = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("amount", T.IntegerType())])
    good, dead = decode_json(df, "value", schema, lenient_ints=True)
    assert rows(dead, "id") == [(2,)]
    assert rows(good, "id", "amount") == [(1, 5), (3, 0), (4, 0), (5, 7), (6, None)]
    # whole numbers of the target type, cut towards zero; what it does not hold is 0
    texts = [("3000000000", 3000000000), ("7.9", 7), ('"7.5"', 7), ("-7.9", -7), ("9223372036854775807", 2**63 - 1),
             ("9223372036854775808", 0), ("1e3", 1000), ('" 5 "', 5), ("true", 0), ("null", 0)]
    df2 = spark.createDataFrame([(i, f'{{"amount":{t}}}') for i, (t, _) in enumerate(texts)], "id long, value string")
    big = T.StructType([T.StructField("amount", T.LongType())])
    assert rows(decode_json(df2, "value", big, lenient_ints=True)[0], "id", "amount") == [(i, v) for i, (_, v) in enumerate(texts)]
    both = parse_json(df, "value", schema, lenient_ints=True)
    assert rows(both.filter("bad_record IS NOT NULL"), "id", "bad_record") == [(2, "not json")]
    enc = df.select(encode_json(F.lit(None).cast("string")).alias("v")).first().v
    assert enc is None


def test_empty_input_keeps_schema(spark):
    empty = spark.createDataFrame([], "name string, ts timestamp")
    out = tumbling_count(empty, "name", "ts", "30 seconds")
    assert out.count() == 0 and out.columns == ["name", "window_start", "window_end", "count"]
    assert session_count(empty, "name", "ts", 300).count() == 0
