"""Streams keep their tables right however their micro-batches are cut, and when one runs again."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import windows as W
from ledgerloom.sources import files
from ledgerloom.streaming import replay
from ledgerloom.streaming.extremes import DailyExtremes

SCHEMA = "user long, total long, day date"


def feed(spark, path, parts, schema):
    """Files in the order of ``parts``, one a micro-batch."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/feed/{i}")
    return files.stream_table(spark, schema, f"{path}/feed/*", "parquet", files_per_trigger=1)


def totals(rows):
    return rows.groupBy("user", "day").agg(F.sum("cents").alias("total"))


def combined(rows):
    return rows.groupBy("user", "day").agg(F.sum("total").alias("total"))


def told(df):
    return sorted((r.user, r.day.isoformat() if r.day else None, r.total) for r in df.select("user", "day", "total").collect())


@pytest.fixture
def home(tmp_path):
    return f"file://{tmp_path}"


def test_a_date_in_many_micro_batches_loses_nothing(spark, home):
    day = dt.date(2024, 1, 5)
    parts = [[(u, day, 1) for u in range(i, 1000, 4)] for i in range(4)]
    facts = replay.DailyParts(spark, f"{home}/fact", "day")
    replay.append_facts(feed(spark, home, parts, "user long, day date, total long"), lambda rows: rows, facts, f"{home}/checkpoint")
    assert facts.read(SCHEMA).count() == 1000
    facts.compact(SCHEMA)
    assert facts.read(SCHEMA).count() == 1000 and facts.live() == {"2024-01-05": ["3w"]}


def test_any_order_and_reruns_equal_the_batch(spark, home):
    rng = random.Random(3)
    rows = [(rng.randrange(5), dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(6)), rng.randrange(100)) for _ in range(400)]
    parts = [rows[i::5] for i in range(5)]
    schema = "user long, day date, cents long"
    want = told(totals(spark.createDataFrame(rows, schema)))
    facts = replay.DailyParts(spark, f"{home}/fact", "day", combined)
    replay.append_facts(feed(spark, home, parts, schema), totals, facts, f"{home}/checkpoint")
    assert told(facts.read(SCHEMA)) == want
    last = [totals(spark.createDataFrame(r.collect(), schema)) for r in [spark.read.schema(schema).parquet(f"{home}/feed/4")]][0]
    for _ in range(2):  # the last micro-batch again, before and after compaction, and compaction again
        facts.write(last, 4)
        assert told(facts.read(SCHEMA)) == want
        facts.compact(SCHEMA)
        assert told(facts.read(SCHEMA)) == want
    assert all(p == ["4w"] for p in facts.live().values())
    assert told(facts.read(SCHEMA, ["2024-01-02"])) == [r for r in want if r[1] == "2024-01-02"]
    facts.write(totals(spark.createDataFrame([(1, dt.date(2024, 1, 2), 7), (9, None, 1)], schema)), 5)
    more = dict(((u, d), n) for u, d, n in want)
    more[1, "2024-01-02"] = more.get((1, "2024-01-02"), 0) + 7
    assert told(facts.read(SCHEMA).filter("day IS NOT NULL")) == sorted((u, d, n) for (u, d), n in more.items())
    assert told(facts.read(SCHEMA).filter("day IS NULL")) == [(9, None, 1)]
    replay.reprocess(spark.createDataFrame([(2, dt.date(2024, 1, 2), 5)], schema), "2024-01-02", totals, facts)
    assert told(facts.read(SCHEMA, ["2024-01-02"])) == [(2, "2024-01-02", 5)]


def test_an_unfinished_part_does_not_count(spark, home):
    facts = replay.DailyParts(spark, f"{home}/fact", "day", combined)
    facts.write(totals(spark.createDataFrame([(1, dt.date(2024, 1, 1), 3)], "user long, day date, cents long")), 0)
    facts.write(totals(spark.createDataFrame([(1, dt.date(2024, 1, 1), 4)], "user long, day date, cents long")), 1)
    facts.files.delete(f"{home}/fact/part_=1/_SUCCESS")
    assert told(facts.read(SCHEMA)) == [(1, "2024-01-01", 3)]


def test_target_commits_all_buckets_at_once(spark, home):
    row = "k long, v long"
    target = replay.Target(spark, home, spark.createDataFrame([], row), ["k"], 4)
    put = lambda rows, n: target.write(spark.createDataFrame(rows, row), sorted({r[0] for r in spark.createDataFrame(rows, row).select(target.number).distinct().collect()}), n)
    held = lambda **a: sorted(map(tuple, replay.Target(spark, home, spark.createDataFrame([], row), ["k"], 4).read(**a).collect()))
    put([(k, 0) for k in range(20)], 0)
    put([(k, 1) for k in range(20)], 1)
    target.files.delete(f"{home}/commits/1/_SUCCESS")  # as if it had failed before its end: buckets lie there, but don't count
    assert held() == [(k, 0) for k in range(20)]
    put([(k, 1) for k in range(20)], 1)
    assert held() == [(k, 1) for k in range(20)] and held(before=1) == [(k, 0) for k in range(20)]
    for n in range(2, 6):
        put([(k, n) for k in range(20)], n)
    assert held() == [(k, 5) for k in range(20)]
    assert target.files.names(f"{home}/table", "version_=") == ["4", "5"] and target.commits() == [4, 5]
    own = [k for (k,) in [(r.k,) for r in spark.range(20).selectExpr("id AS k").withColumn("b", target.number).filter("b = 2").collect()]]
    target.write(spark.createDataFrame([], row), [2], 6)  # a bucket that is left without rows
    assert held() == [(k, 5) for k in range(20) if k not in own]


def prices(days, seed=1, symbols=3, missing=0.2):
    rng = random.Random(seed)
    first = dt.date(2020, 1, 1)
    return [(f"S{s}", first + dt.timedelta(d), rng.randrange(50), 50 + rng.randrange(50)) for d in range(days) for s in range(symbols) if rng.random() > missing]


PRICES = "symbol string, day date, low long, high long"
OUT = ("symbol", "day", "low_value", "low_day", "high_value", "high_day")


def brute(rows, days):
    out = []
    for s, d, *_ in rows:
        frame = [r for r in rows if r[0] == s and d - dt.timedelta(days - 1) <= r[1] <= d]
        lo, hi = min((r[2], r[1]) for r in frame), min((-r[3], r[1]) for r in frame)
        out.append((s, d, lo[0], lo[1], -hi[0], hi[1]))
    return sorted(out)


def test_daily_extremes_in_any_order(spark, home):
    rows = prices(160)
    random.Random(2).shuffle(rows)
    kept = DailyExtremes(spark, home, PRICES, ["symbol"], "day", "low", "high", 45)
    kept.run(feed(spark, home, [rows[i::3] for i in range(3)], PRICES), f"{home}/checkpoint")
    assert sorted(map(tuple, kept.read().select(*OUT).collect())) == brute(rows, 45)


def test_a_day_reads_its_year_only(spark, home):
    rows = prices(900, symbols=2)
    kept = DailyExtremes(spark, home, PRICES, ["symbol"], "day", "low", "high")
    last = max(r[1] for r in rows)
    for n, keep in enumerate((lambda r: r[1] < last - dt.timedelta(1), lambda r: r[1] == last - dt.timedelta(1), lambda r: r[1] == last)):
        kept.step(spark.createDataFrame([r for r in rows if keep(r)], PRICES), n)
    assert sorted(map(tuple, kept.read().select(*OUT).collect())) == brute(rows, 365)
    own = spark.createDataFrame([r for r in rows if r[1] == last], PRICES).withColumn("month_", F.trunc("day", "month"))
    read = [f.split("/month_=")[1][:7] for f in kept._told(own, last, last, 3).inputFiles() if "/daily/" in f]
    begin = last - dt.timedelta(364)
    assert {last.isoformat()[:7], begin.isoformat()[:7]} <= {*read} and len({*read}) <= 4


@pytest.mark.parametrize(("rows", "days"), [(7, None), (None, 40), (None, None), (365, None), (1, None)])
def test_rolling_extremes_by_blocks(spark, rows, days):
    data = [(s, d, lo if i % 7 else None, hi) for i, (s, d, lo, hi) in enumerate(prices(420, seed=4, symbols=2, missing=0.4))]
    found = W.rolling_extremes(spark.createDataFrame(data, PRICES), ["symbol"], "day", "low", "high", rows, days)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"specifiedwindowframe\((?:Row|Range)Frame, -\d", plan, re.I)  # only frames that grow
    want = []
    for s in ("S0", "S1"):
        own = sorted((r for r in data if r[0] == s), key=lambda r: r[1])
        for i, r in enumerate(own):
            frame = own[max(0, i - rows + 1) : i + 1] if rows else [x for x in own[: i + 1] if days is None or x[1] > r[1] - dt.timedelta(days)]
            lo = min(((x[2], x[1]) for x in frame if x[2] is not None), default=(None, None))
            hi = min((-x[3], x[1]) for x in frame)
            want.append((s, r[1], lo[0], lo[1], -hi[0], hi[1]))
    assert sorted(map(tuple, found.select(*OUT).collect())) == sorted(want, key=lambda r: r[:2])


def test_expectations_are_counted_by_the_job_that_writes(spark, home):
    from ledgerloom.operators import audit as A

    df = spark.createDataFrame([(i, None if i % 5 == 0 else i) for i in range(100)], "a long, b long")
    rules = {"small": F.col("b") < 50, "even": F.col("a") % 2 == 0}
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "")
    seen = A.Observed(df, rules, "a", [1, 2])
    seen.df.write.parquet(f"{home}/written")
    counts = seen.counts()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs.getJobIdsForGroup("observed")) == 1
    assert sorted(counts) == sorted(tuple(r) for r in A.expect(df, rules).collect()) == [("even", 50, 50, 0), ("small", 40, 40, 20)]
    assert sorted(tuple(r) for r in seen.counters("t").collect()) == [("t", 1, "even", 0), ("t", 1, "small", 1), ("t", 2, "even", 1), ("t", 2, "small", 1)]


def test_change_files_by_day(spark, home):
    from ledgerloom.sources import tables

    rows = [("I" if i % 3 else "U", i, dt.date(2024, 1, 1 + i % 4)) for i in range(90)] + [("U", 1000 + i, dt.date(2024, 1, 9)) for i in range(50)]
    schema = "cdc_flag string, k long, update_dt date"
    tables.write_change_files(spark.createDataFrame(rows, schema), f"{home}/daily", "update_dt", rows_a_file=20)
    files_ = spark._jvm.java.io.File(home.removeprefix("file://") + "/daily")
    assert sorted(n for n in files_.list() if n.startswith("_pdate=")) == [f"_pdate=2024-01-0{d}" for d in (1, 2, 3, 4, 9)]
    back = files.read_delimited(spark, f"{home}/daily", f"{schema}, _pdate date")
    assert sorted(map(tuple, back.filter("_pdate = update_dt").select("cdc_flag", "k", "update_dt").collect())) == sorted(rows)
    assert len(back.filter("update_dt = '2024-01-09'").select("k").inputFiles()) > 5
