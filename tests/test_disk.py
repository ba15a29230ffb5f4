"""Shuffles leave the disk with the query that made them, and large loads hold those of one slice at a time."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import windows as W
from ledgerloom.sources import tables
from tests.test_queries import ALL, SF, SQL, duck, rows  # noqa: F401


def shuffles(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_written_copy_leaves_no_shuffle(spark):
    df = spark.range(10_000).groupBy((F.col("id") % 1003).alias("k")).agg(F.max("id").alias("m"))
    before = shuffles(spark)
    assert tables.scratch(df, "copy").count() == 1003 and spark.conf.get(tables._CLEANUP) == "false"
    with tables.freed(spark):
        df.count()
    made = shuffles(spark) - before
    df.count()
    assert len(made) <= 4 < len(shuffles(spark) - before)  # of the count of the copy, and without ``freed``


def test_slices_equal_the_whole(spark):
    a = tables.scratch(spark.range(5000).select((F.col("id") % 700).alias("k"), "id"), "a")
    b = tables.scratch(spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v")), "b")
    seen = []

    def each(x, y):
        seen.append(x.count())
        return x.join(y, "k").groupBy("k", "v").agg(F.sum("id").alias("s"))

    told = lambda n: sorted(map(tuple, tables.by_slices(each, [a, b], ["k"], "out", n).collect()))
    assert told(None) == told(7) and len(told(7)) == 600
    assert seen[0] == 5000 and max(seen[1:8]) < 1200 and sum(seen[1:8]) == 5000


def test_months_between_are_looked_up_not_spread(spark):
    day = dt.date(2020, 1, 1)
    daily = spark.range(800).select((F.col("id") % 2).alias("k"), F.date_add(F.lit(day), F.col("id").cast("int")).alias("day"), "id")
    marked = W.with_extremes(daily, "day", "id", "id").withColumn("month_", F.trunc("day", "month"))
    monthly = marked.groupBy("k", "month_").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    for days in (32, 60, 365, 400):
        found = W.rolling_extremes_by_month(daily.select("k", "day"), marked, monthly, ["k"], "day", days)
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
        want = [(i % 2, i - (i - max(i % 2, i - days + 1)) // 2 * 2, i) for i in range(800)]
        assert sorted((r.k, r.low_value, r.high_value) for r in found.collect()) == sorted(want)


#: What these load is written when the query returns.
LOADS = ["wh_market_daily", "wh_dim_trade", "wh_fact_holdings", "wh_message_log", "wh_fact_market_history", "wh_market_incremental", "wh_audits", "wh_holdings_stream", "wh_holdings_incremental", "wh_null_keys", "wh_completeness", "wh_alerts_expected", "wh_alerts"]


@pytest.mark.parametrize("name", LOADS)
def test_a_load_leaves_no_shuffle(spark, duck, monkeypatch, name):  # noqa: F811
    monkeypatch.setattr(tables, "ROWS_A_CORE", 500)  # some three slices
    before = shuffles(spark)
    found = ALL[name](spark, SF)
    assert not shuffles(spark) - before
    assert rows(found.toPandas()) == rows(duck.sql(SQL[name]).df())
