"""Forms for keys that hold a great part of all rows equal the plain ones, and deal these keys over tasks."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import changes as K
from ledgerloom.operators import history as H
from ledgerloom.operators import windows as W
from ledgerloom.sources import tables

DAY = dt.date(2020, 1, 1)


def log(n, seed=1):
    """One key has a third of all rows; values, keys and times are null here and there."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rng.random() < 0.4 else rng.choice([1, 2, 3, None])
        at = dt.datetime(2020, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 40))
        rows.append((k, at, i, rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(9)])))
    return rows


SCHEMA = "k long, ts timestamp_ntz, seq long, name string, n long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_running_sum_and_lead_by_blocks(spark):
    df = spark.createDataFrame(log(600), SCHEMA)
    week = F.trunc(F.to_date("ts"), "week")
    assert rows(W.running_sum_blocks(df, ["k"], ["ts", "seq"], "n", week)) == rows(W.running_sum(df, ["k"], ["ts", "seq"], "n"))
    led = W.lead_blocks(df, ["k"], ["ts", "seq"], F.col("n"), week, "next")
    w = F.lead("n").over(W.Window.partitionBy("k").orderBy("ts", "seq"))
    assert rows(led) == rows(df.withColumn("next", w))
    index = W.row_index(df, ["k"], ["ts", "seq"], week)
    assert rows(index) == rows(df.withColumn("idx", (F.row_number().over(W.Window.partitionBy("k").orderBy("ts", "seq")) - 1).cast("long")))


def test_versions_by_blocks(spark):
    df = spark.createDataFrame([r for r in log(500, 2) if r[0] is not None], SCHEMA)
    week = F.trunc(F.to_date("ts"), "week")
    assert rows(H.scd2_build(df, ["k"], "ts", ["seq"], block=week)) == rows(H.scd2_build(df, ["k"], "ts", ["seq"]))
    assert rows(H.scd2_last_of_day(df, ["k"], "ts", ["seq"], block=F.trunc("effectivedate", "week"))) == rows(H.scd2_last_of_day(df, ["k"], "ts", ["seq"]))


def spans(n, seed, keys=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = DAY + dt.timedelta(rng.randrange(900))
        b = rng.choice([a, a + dt.timedelta(rng.randrange(1, 200)), dt.date(9999, 12, 31)])
        out.append((rng.randrange(keys), i, a, b))
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
def test_overlaps_by_bucket(spark, how):
    one = spark.createDataFrame([*spans(60, 1), (9, 99, DAY, dt.date(9999, 12, 31))], "k long, a long, effectivedate date, enddate date")
    two = spark.createDataFrame(spans(60, 2), "k long, b long, effectivedate date, enddate date")
    plain = H.overlap_join(one, two, ["k"], how=how)
    if how == "inner":  # a version without days overlaps nothing
        plain = plain.filter("effectivedate < enddate")
    found = H.overlap_join(one, two, ["k"], how=how, bucket_days=100).select(plain.columns)
    assert {r for r in rows(found) if r[2] < r[3]} == {r for r in rows(plain) if r[2] < r[3]}
    assert len(rows(found)) == len({*rows(found)})


def test_overlap_of_one_key_with_very_many_versions(spark):
    days = spark.range(100_000).select(F.lit(1).alias("k"), F.col("id").alias("a"), F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("effectivedate")).withColumn("enddate", F.date_add("effectivedate", 1))
    months = spark.range(3_285).select(F.lit(1).alias("k"), F.col("id").alias("b"), F.add_months(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("effectivedate")).withColumn("enddate", F.add_months("effectivedate", 1))
    found = H.overlap_join(days, months, ["k"], bucket_days=90)
    assert found.count() == found.filter("enddate = date_add(effectivedate, 1)").count() == 99_985 or found.count() > 99_000


def brute_history(events, cols=("name", "n")):
    """Every key's state at the end of each day that has events."""
    out = []
    for k in sorted({e[0] for e in events}):
        state, days = {}, {}
        for e in sorted((e for e in events if e[0] == k), key=lambda e: (e[1], e[2])):
            state |= {c: v for c, v in zip(cols, e[3:], strict=True) if v is not None}
            days[e[1].date()] = (e[1], e[2], *(state.get(c) for c in cols))
        starts = sorted(days)
        for a, b in zip(starts, [*starts[1:], dt.date(9999, 12, 31)], strict=True):
            out.append((k, *days[a], a, b))
    return sorted(out, key=str)


def test_clocked_merges_in_any_order_and_again(spark):
    events = [e for e in log(300, 3) if e[0] is not None]
    want = brute_history(events)
    cols = ["k", "ts", "seq", "name", "n", "effectivedate", "enddate"]
    for seed in range(3):
        order = events[:]
        random.Random(seed).shuffle(order)
        cut = [order[:80], order[80:150] + order[:10], order[150:] + order[100:120]]
        df = [spark.createDataFrame(c, SCHEMA) for c in cut]
        held = K.clocked_history(df[0], ["k"], "ts", ["seq"], ["name", "n"])
        for d in df[1:]:
            held = tables.scratch(K.clocked_merge(held, d, ["k"], "ts", ["seq"], ["name", "n"], block=F.trunc(F.to_date("ts"), "week") if seed else None), "held")
        assert rows(held.select(cols)) == want
    late = K.clocked_merge(held, spark.createDataFrame([(*events[0][:3], "changed", None)], SCHEMA), ["k"], "ts", ["seq"], ["name", "n"])
    assert rows(late.select(cols)) == brute_history([(*e[:3], "changed", e[4]) if e[2] == events[0][2] else e for e in events])


def test_bucketed_tables_join_without_exchange(spark):
    trades = spark.range(2000).select((F.col("id") % 50).alias("account"), F.col("id").alias("trade"), F.date_add(F.lit(DAY), (F.col("id") % 300).cast("int")).alias("day"))
    dim = spark.range(50).select(F.col("id").alias("account"), F.lit(DAY).alias("effectivedate"), F.lit(dt.date(9999, 12, 31)).alias("enddate"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = H.as_of_join(tables.bucketed(trades, ["account"], 4), tables.bucketed(dim, ["account"], 4), ["account"], "day")
        assert joined.count() == 2000 and "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_either_column_prunes_files(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    df = spark.range(40_000).select((F.rand(1) * 1000).cast("long").alias("a"), F.date_add(F.lit(DAY), (F.pow(F.rand(2), 3) * 1000).cast("int")).alias("b"), F.when(F.rand(3) > 0.1, F.rand(4)).alias("c"))
    tables.clustered_by_all(df, f"file://{tmp_path}/z", ["a", "b"], 16)
    files = glob.glob(f"{tmp_path}/z/*.parquet")
    assert len(files) == 16 and spark.read.parquet(f"file://{tmp_path}/z").exceptAll(df).isEmpty()
    stats = [[pq.read_metadata(f).row_group(0).column(i).statistics for i in (0, 1)] for f in files]
    hit = lambda i, x: sum(s[i].min <= x <= s[i].max for s in stats)
    assert hit(0, 500) <= 8 and hit(1, DAY + dt.timedelta(500)) <= 8 and hit(1, DAY + dt.timedelta(3)) <= 8
