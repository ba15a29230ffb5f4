from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import audit as A
from ledgerloom.operators import changes as K
from ledgerloom.operators import history as H
from ledgerloom.operators import windows as W

DAY = dt.datetime(2020, 1, 1)


def log(spark, seed, n=120, keys=6):
    rng = random.Random(seed)
    rows = [(rng.randrange(keys), DAY + dt.timedelta(hours=rng.randrange(24 * 20)), i, rng.choice([None, "a", "b", "c"]), rng.choice([None, None, 1, 2])) for i in range(n)]
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, seq long, x string, y int")


def build(events):
    return H.scd2_build(H.forward_fill(events, ["k"], ["ts", "seq"], ["x", "y"]), ["k"], "ts", ["seq"])


def same(a, b):
    cols = sorted(a.columns)
    return sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_keep_their_invariants(spark, seed):
    v = build(log(spark, seed))
    assert {r.result for r in A.check_scd2("v", v, ["k"]).collect()} == {"OK"}
    other = H.scd2_last_of_day(H.forward_fill(log(spark, seed), ["k"], ["ts", "seq"], ["x", "y"]), ["k"], "ts", ["seq"])
    assert same(v, other)


@pytest.mark.parametrize("seed", [3, 4])
def test_merging_in_any_order_equals_rebuilding(spark, seed):
    """Full rows a day: late, repeated and out-of-order batches give the history of all events."""
    e = H.latest(H.forward_fill(log(spark, seed), ["k"], ["ts", "seq"], ["x", "y"]).withColumn("d", F.to_date("ts")), ["k", "d"], ["ts", "seq"]).drop("d").cache()
    whole = H.scd2_build(e, ["k"], "ts", ["seq"])
    held = H.scd2_build(e.limit(0), ["k"], "ts", ["seq"])
    for part in (2, 0, 1, 0):
        held = K.scd2_merge(held, e.filter(F.col("seq") % 3 == part), ["k"], "ts", ["seq"], ["x", "y"])
    assert same(whole, held)


def test_two_row_form_of_the_merge(spark):
    d = lambda s: dt.date.fromisoformat(s)
    end = d(H_OPEN)
    target = spark.createDataFrame([(1, "a", 5, d("2020-01-01"), end, True), (2, "b", 6, d("2020-01-01"), end, True)], "k long, x string, y int, effectivedate date, enddate date, iscurrent boolean")
    changes = spark.createDataFrame([(1, None, 7, d("2020-02-01")), (3, "n", 1, d("2020-02-01"))], "k long, x string, y int, day date")
    got = {tuple(r) for r in K.scd2_rows(target, changes, ["k"], "day", ["x", "y"]).collect()}
    assert got == {(1, "a", 5, d("2020-01-01"), d("2020-02-01"), False), (1, "a", 7, d("2020-02-01"), end, True), (3, "n", 1, d("2020-02-01"), end, True)}


H_OPEN = "9999-12-31"


def test_same_day_events_collapse_but_are_filled_first(spark):
    rows = [(1, DAY, 1, "a", None), (1, DAY + dt.timedelta(hours=1), 2, None, 9), (1, DAY + dt.timedelta(days=2), 3, "b", None)]
    v = build(spark.createDataFrame(rows, "k long, ts timestamp_ntz, seq long, x string, y int")).orderBy("effectivedate").collect()
    assert [(r.x, r.y, str(r.effectivedate), str(r.enddate), r.iscurrent) for r in v] == [("a", 9, "2020-01-01", "2020-01-03", False), ("b", 9, "2020-01-03", H_OPEN, True)]


def test_as_of_is_half_open_and_overlap_clips(spark):
    dim = spark.sql("SELECT * FROM VALUES (1, 'v1', DATE'2020-01-01', DATE'2020-02-01'), (1, 'v2', DATE'2020-02-01', DATE'9999-12-31') AS t(k, v, effectivedate, enddate)")
    fact = spark.sql("SELECT * FROM VALUES (1, DATE'2019-12-31'), (1, DATE'2020-01-31'), (1, DATE'2020-02-01') AS t(k, at)")
    assert [(str(r["at"]), r.v) for r in H.as_of_join(fact, dim, ["k"], "at").orderBy("at").collect()] == [("2020-01-31", "v1"), ("2020-02-01", "v2")]
    left = spark.sql("SELECT * FROM VALUES (1, 'a', DATE'2020-01-15', DATE'2020-02-10'), (2, 'b', DATE'2020-01-01', DATE'2020-01-02') AS t(k, x, effectivedate, enddate)")
    got = [(r.k, r.x, r.v, str(r.effectivedate), str(r.enddate)) for r in H.overlap_join(left, dim, ["k"], how="left").orderBy("k", "effectivedate").collect()]
    assert got == [(1, "a", "v1", "2020-01-15", "2020-02-01"), (1, "a", "v2", "2020-02-01", "2020-02-10"), (2, "b", None, "2020-01-01", "2020-01-02")]


def test_extremes_take_the_earliest_day(spark):
    p = spark.sql("SELECT * FROM VALUES ('s', DATE'2020-01-01', 5, 9), ('s', DATE'2020-01-03', 5, 9), ('s', DATE'2020-01-09', 6, 8) AS t(s, d, lo, hi)")
    by_rows = W.rolling_extremes(p, ["s"], "d", "lo", "hi", rows=2).orderBy("d").collect()
    assert [(r.low_value, str(r.low_day), r.high_value, str(r.high_day)) for r in by_rows] == [(5, "2020-01-01", 9, "2020-01-01"), (5, "2020-01-01", 9, "2020-01-01"), (5, "2020-01-03", 9, "2020-01-03")]
    by_days = W.rolling_extremes(p, ["s"], "d", "lo", "hi", days=7).orderBy("d").collect()
    assert [(r.low_value, str(r.low_day)) for r in by_days] == [(5, "2020-01-01"), (5, "2020-01-01"), (5, "2020-01-03")]


def test_guarded_upsert_and_stale_changes(spark):
    t = spark.sql("SELECT * FROM VALUES (1, 5, 'open', 10), (2, 5, 'closed', 10), (3, 9, 'open', 10) AS t(k, ts, status, v)")
    c = spark.sql("SELECT * FROM VALUES (1, 6, 'closed', CAST(NULL AS INT)), (2, 6, 'open', 1), (3, 8, 'open', 1), (4, 1, 'open', 7) AS t(k, ts, status, v)")
    got = {tuple(r) for r in K.scd1_merge(t, c, ["k"], ["ts"], guard=t["status"] == "open").collect()}
    assert got == {(1, 6, "closed", 10), (2, 5, "closed", 10), (3, 9, "open", 10), (4, 1, "open", 7)}


def test_watch_merge(spark):
    t = spark.sql("SELECT * FROM VALUES (1, 'A', 10, CAST(NULL AS INT)), (2, 'B', 10, 11) AS t(c, s, placed, removed)")
    n = spark.sql("SELECT * FROM VALUES (1, 'A', CAST(NULL AS INT), 20), (2, 'B', NULL, 20), (3, 'C', 15, NULL), (4, 'D', 15, 16) AS t(c, s, placed, removed)")
    table, lost = K.open_close_merge(t, n, ["c", "s"], "placed", "removed")
    assert {tuple(r) for r in table.collect()} == {(1, "A", 10, 20), (2, "B", 10, 11), (3, "C", 15, None), (4, "D", 15, 16)}
    assert [(r.c, r.s) for r in lost.collect()] == [(2, "B")]


def test_apply_changes_type_two_with_deletes(spark):
    c = spark.sql("SELECT * FROM VALUES (1, 1, 'a', false), (1, 3, 'b', false), (1, 5, 'b', true), (2, 2, 'x', false) AS t(k, s, v, gone)")
    got = {(r.k, r.v, r.start_at, r.end_at) for r in K.apply_changes([c], ["k"], ["s"], scd=2, delete_when=F.col("gone")).collect()}
    assert got == {(1, "a", 1, 3), (1, "b", 3, 5), (2, "x", 2, None)}


def test_dense_index_over_many_partitions(spark):
    df = spark.range(0, 500, 1, 7).select((F.col("id") * 37 % 500).alias("x"))
    assert [r.idx for r in W.dense_index(df, ["x"]).orderBy("x").collect()] == list(range(500))
    assert W.dense_index(df.limit(0), ["x"]).count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_forms_for_hot_keys_equal_the_plain_ones(spark, seed):
    e = log(spark, seed, n=200, keys=2)
    plain = H.forward_fill(e, ["k"], ["ts", "seq"], ["x", "y"])
    assert same(plain, H.forward_fill_blocks(e, ["k"], ["ts", "seq"], ["x", "y"], F.to_date("ts")))
    v = H.scd2_build(plain, ["k"], "ts", ["seq"]).select("k", F.col("seq").alias("version"), "effectivedate", "enddate")
    fact = e.select("k", F.col("ts").alias("at"), "seq")
    for how in ("inner", "left"):
        assert same(H.as_of_join(fact, v, ["k"], "at", how=how), H.as_of_join(fact, v, ["k"], "at", how=how, bucket_days=3))
