"""Warehouse facts kept up by streams, and the daily change files that such streams read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import clean as C
from ledgerloom.operators import audit as A
from ledgerloom.operators import changes as K
from ledgerloom.operators import history as H
from ledgerloom.operators import windows as W
from ledgerloom.plans import warehouse_queries as loaded
from ledgerloom.plans.queries import dated, fed
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.sources import files, tables
from ledgerloom.streaming import replay
from ledgerloom.streaming.extremes import DailyExtremes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf: dated(f(Warehouse(spark, sf)))
        SQL[f.__name__] = loaded._CTES + sql
        return f

    return register


@query("SELECT t_id, CAST(strftime(placed, '%Y%m%d') AS BIGINT) AS sk_createdateid, CAST(strftime(closed, '%Y%m%d') AS BIGINT) AS sk_closedateid, status FROM life")
def wh_trade_stream(w):
    """Trades from a stream of status events in any order; each micro-batch rewrites only the buckets of its trades."""
    home, log = tables.scratch_path(w.spark, "trades"), w.feed.trade_history
    source = fed(log, "th_dts", home)
    seed = log.limit(0).select("t_id", F.col("th_dts").alias("create_ts"), "th_dts", "status")
    told = lambda rows: rows.withColumn("create_ts", F.when(F.col("status") == "SBMT", F.col("th_dts")))
    held = replay.fold(source, seed, lambda held, batch: K.lifecycle_totals(held, told(batch), ["t_id"], "create_ts", "th_dts", "status"), home, ["t_id"])
    closed = F.when(F.col("status").isin("CMPT", "CNCL"), F.col("th_dts"))
    return held.select("t_id", C.date_key("create_ts").alias("sk_createdateid"), C.date_key(closed).alias("sk_closedateid"), C.map_codes("status", C.STATUS).alias("status"))


@query(loaded.SQL["wh_watches_incremental"].removeprefix(loaded._CTES))
def wh_watch_stream(w):
    """Watches from a stream of placements and cancellations in any order."""
    home, log = tables.scratch_path(w.spark, "watches"), w.feed.watches
    source, keys = fed(log, "ts", home), ["customerid", "symbol"]
    seed = H.open_close(log.limit(0), keys, "action", "ts", "CNCL")
    step = lambda held, batch: K.open_close_totals(held, H.open_close(batch, keys, "action", "ts", "CNCL"), keys, "placed", "removed")
    held = replay.fold(source, seed, step, home, keys).filter("placed IS NOT NULL")
    return held.select(*keys, C.date_key("placed").alias("sk_dateplaced"), C.date_key("removed").alias("sk_dateremoved"))


@query(loaded.SQL["wh_fact_holdings"].removeprefix(loaded._CTES))
def wh_holdings_stream(w):
    """Holdings by month: history is loaded once, then a stream in which months come in pieces looks its trades up, passes over what history has, and adds its parts."""
    home, last = tables.scratch_path(w.spark, "holdings"), "1996-12-01"
    t = w.dim_trade.select(F.col("t_id").alias("hh_t_id"), "sk_accountid", "sk_customerid", F.col("sk_closedateid").alias("sk_dateid"), F.col("cents").alias("currentprice"))
    at = w.feed.trades.select(F.col("t_id").alias("hh_t_id"), F.trunc("shipped", "month").alias("month"))
    rows = tables.by_slices(lambda held, at: held.join(at, "hh_t_id"), [w.feed.holdings, at], ["hh_t_id"], "holdings")
    told = lambda x: x.join(t, "hh_t_id")
    parts = replay.DailyParts(w.spark, f"{home}/fact", "month")
    source = fed(rows, "hh_t_id", home)
    first = told(rows.filter(F.col("month") <= F.lit(last).cast("date")))
    replay.seeded(first, parts)
    replay.append_facts(source, told, parts, f"{home}/checkpoint", after=last)
    return parts.read(first.schema).select("hh_t_id", "change", "sk_accountid", "sk_customerid", "sk_dateid", "currentprice")


@query(loaded.SQL["wh_account_replay"].removeprefix(loaded._CTES))
def wh_account_chained(w):
    """Customers and accounts each from a stream of their own; what these change is a stream again, by which the accounts' versions are cut anew."""
    home = tables.scratch_path(w.spark, "chained")
    c_cols, a_cols = ["lastname", "tier", "gender", "city", "nat_tx"], ["customerid", "status", "brokerid"]
    c_log, a_log = C.blank_to_null(w.feed.customer_log), w.feed.account_log

    def kept(name: str, log: DataFrame, key: str, cols: list[str]) -> tuple[str, DataFrame]:
        at = f"{home}/{name}"
        seed = K.clocked_history(log.limit(0), [key], "ts", ["seq"], cols)
        step = lambda held, batch: K.clocked_merge(held, batch, [key], "ts", ["seq"], cols)
        replay.fold(fed(log.select(key, "ts", "seq", *cols), "seq", at), seed, step, at, [key], changes=[key, "effectivedate", "enddate"])
        return at, seed

    c_at, c_seed = kept("customers", c_log, "customerid", c_cols)
    a_at, a_seed = kept("accounts", a_log, "accountid", a_cols)
    owners = lambda: replay.Target(w.spark, c_at, c_seed, ["customerid"], replay.BUCKETS)
    accounts = lambda: replay.Target(w.spark, a_at, a_seed, ["accountid"], replay.BUCKETS)

    def touched(batch: DataFrame) -> DataFrame:
        """Accounts that changed themselves, and those of owners that did."""
        own = batch.filter("kind = 'A'").select(F.col("id").alias("accountid"))
        of = batch.filter("kind = 'C'").select(F.col("id").alias("customerid")).distinct()
        return own.union(accounts().read().select("accountid", "customerid").join(of, "customerid", "left_semi").select("accountid")).distinct()

    def step(held: DataFrame, ids: DataFrame) -> DataFrame:
        told = accounts()
        rows = told.read(sorted(r[0] for r in ids.select(told.number).distinct().collect())).join(ids, "accountid", "left_semi").drop("ts", "seq", "clocks", "iscurrent")
        people = owners()
        own = people.read(sorted(r[0] for r in rows.select(people.number).distinct().collect())).select("customerid", "effectivedate", "enddate", C.version_key("effectivedate", "customerid").alias("sk_customerid"))
        both = H.overlap_join(rows, own, ["customerid"], how="left").select(*held.columns)
        return held.join(ids, "accountid", "left_anti").unionByName(both)

    stream = replay.changes_of(w.spark, c_at, "customerid long").select(F.col("customerid").alias("id"), F.lit("C").alias("kind")).union(replay.changes_of(w.spark, a_at, "accountid long").select(F.col("accountid").alias("id"), F.lit("A").alias("kind")))
    dim = replay.fold(stream, w.spark.createDataFrame([], "accountid long, sk_customerid long, status string, brokerid long, effectivedate date, enddate date"), step, f"{home}/dim", ["accountid"], prepare=touched)
    return dim.select(C.version_key("effectivedate", "accountid").alias("sk_accountid"), "accountid", "sk_customerid", "brokerid", C.map_codes("status", C.STATUS).alias("status"), "effectivedate", "enddate", (F.col("enddate") == H.open_end()).alias("iscurrent"))


_RANGE = loaded.SQL["wh_fact_market_history"].removeprefix(loaded._CTES).replace("ROWS BETWEEN 364 PRECEDING AND CURRENT ROW", "RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW")


@query(_RANGE)
def wh_market_by_days(w):
    """The market fact over the last 365 days (not rows), in one batch."""
    return tables.by_slices(lambda days: w.market_told(W.rolling_extremes(days, ["symbol"], "day", "low", "high", days=365)), [w.feed.market], ["symbol"], "fact")


@query(_RANGE)
def wh_market_daily(w):
    """The same fact by a stream of market days, each reading the months at the edges of its year and one row a month between."""
    home, market = tables.scratch_path(w.spark, "market"), w.feed.market
    source = fed(market, "day", home)
    kept = DailyExtremes(w.spark, home, market.schema, ["symbol"], "day", "low", "high")
    kept.run(source, f"{home}/checkpoint")
    return tables.by_slices(lambda days, extremes: w.market_told(days.join(extremes, ["symbol", "day"])), [market, kept.read()], ["symbol"], "fact")


_DAILY = {
    "customer": ("cust_log", "customerid", "ts"), "account": ("acct_log", "accountid", "ts"), "cash": ("orders", "o_custkey", "o_orderdate"), "market": ("(SELECT DISTINCT l_partkey, CAST(l_shipdate AS DATE) AS d FROM lineitem)", "l_partkey", "d"),
    "trade": ("(SELECT t_id, placed AS ts FROM trade UNION ALL SELECT t_id, shipped FROM trade WHERE flag = 'R' OR line = 'F')", "t_id", "ts"), "holding": ("trade WHERE line = 'F'", "t_id", "shipped"),
    "watch": ("(SELECT user_id * 20 + event_id % 20 AS pair, ts FROM events WHERE event_type <> 'error')", "pair", "ts"),
}


@query(" UNION ALL ".join(f"SELECT '{n}' AS dataset, CAST(day AS VARCHAR) AS day, count(*) AS rows, count_if(day = first)::BIGINT AS keys_first_seen FROM (SELECT CAST({ts} AS DATE) AS day, min(CAST({ts} AS DATE)) OVER (PARTITION BY {key}) AS first FROM {t}) GROUP BY ALL" for n, (t, key, ts) in _DAILY.items()))
def daily_change_files(w):
    """Seven datasets as change files with their days, read back: rows of each day, and those of keys that come up that day for the first time.

    The files lie in a folder per dataset and month, since a day of one dataset has few rows here; ``tables.write_change_files`` writes a folder a day.
    """
    f, path = w.feed, tables.scratch_path(w.spark, "daily")
    shipped = f.trades.select(F.col("t_id").alias("hh_t_id"), "shipped")
    told = {
        "customer": (f.customer_log, ["customerid"], "ts"), "account": (f.account_log, ["accountid"], "ts"), "cash": (f.cash, ["accountid"], "ct_dts"), "market": (f.market, ["symbol"], "day"),
        "trade": (f.trade_history, ["t_id"], "th_dts"), "holding": (f.holdings.join(shipped, "hh_t_id"), ["hh_t_id"], "shipped"), "watch": (f.watches, ["customerid", "symbol"], "ts"),
    }
    out = []
    for name, (df, keys, ts) in told.items():
        rows = df.withColumn("update_dt", F.to_date(ts)).withColumn("month", F.trunc("update_dt", "month"))
        first = rows.groupBy(*keys).agg(F.min("update_dt").alias("_first"))
        flagged = rows.join(first, keys).withColumn("cdc_flag", F.when(F.col("update_dt") == F.col("_first"), "I").otherwise("U")).drop("_first")
        tables.write_by_date(flagged, f"{path}/{name}", "month")
        back = w.spark.read.parquet(f"{path}/{name}").filter("_pdate = month")
        out.append(back.groupBy(F.col("update_dt").alias("day")).agg(F.count("*").alias("rows"), F.count_if(F.col("cdc_flag") == "I").alias("keys_first_seen")).withColumn("dataset", F.lit(name)))
    return A.union(out).select("dataset", "day", "rows", "keys_first_seen")
