"""One query per operator over the given tables, each with the SQL that says the same.

Money is summed up in whole cents and dates are returned as text, so that results compare
exactly between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import clean as C
from ledgerloom.operators import audit as A
from ledgerloom.operators import changes as K
from ledgerloom.operators import history as H
from ledgerloom.operators import matching as M
from ledgerloom.operators import windows as W
from ledgerloom.sources import files, tables
from ledgerloom.streaming import replay, state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf: dated(f(Tables(spark, sf)))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def dated(df: DataFrame) -> DataFrame:
    """Dates as text; whole numbers as 64 bits."""
    kinds = {T.DateType: "string", T.IntegerType: "long", T.ShortType: "long", T.ByteType: "long", T.DecimalType: "long"}
    return df.select(*[df[f.name].cast(kinds[type(f.dataType)]).alias(f.name) if type(f.dataType) in kinds else df[f.name] for f in df.schema])


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def cents(col) -> F.Column:
    return F.round(F.col(col) * 100).cast("long")


def sparse(t: Tables) -> DataFrame:
    """Events as a change log in which most updates tell only some columns."""
    e = t.events
    return e.select("event_id", "user_id", "ts", F.when(e.event_id % 3 != 0, cents("value")).alias("cents"), F.when(e.event_id % 4 != 1, F.col("event_type")).alias("kind"))


_SPARSE = """sparse AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS cents,
  CASE WHEN event_id % 4 <> 1 THEN event_type END AS kind FROM events)"""
_FILLED = f"""{_SPARSE}, filled AS (SELECT event_id, user_id, ts,
  last_value(cents IGNORE NULLS) OVER w AS cents, last_value(kind IGNORE NULLS) OVER w AS kind FROM sparse
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_VERSIONS = f"""{_FILLED}, d AS (SELECT *, CAST(ts AS DATE) AS s,
  coalesce(lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, event_id), DATE '9999-12-31') AS e FROM filled),
versions AS (SELECT * FROM d WHERE s < e)"""
_TOLD = "SELECT user_id, event_id, cents, kind, CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate, e = DATE '9999-12-31' AS iscurrent FROM versions"


def versions(t: Tables) -> DataFrame:
    return H.scd2_build(H.forward_fill(sparse(t), ["user_id"], ["ts", "event_id"], ["cents", "kind"]), ["user_id"], "ts", ["event_id"])


_COLS = ("user_id", "event_id", "cents", "kind", "effectivedate", "enddate", "iscurrent")
_WHOLE_LOG = f"WITH {_VERSIONS} {_TOLD}"


# ---- histories


@query(f"WITH {_FILLED} SELECT event_id, user_id, cents, kind FROM filled")
def ffill_user_state(t):
    return H.forward_fill(sparse(t), ["user_id"], ["ts", "event_id"], ["cents", "kind"]).select("event_id", "user_id", "cents", "kind")


@query(f"WITH {_VERSIONS} SELECT v.*, CAST(strftime(s, '%Y%m%d') || user_id AS BIGINT) AS sk FROM ({_TOLD}) v JOIN (SELECT event_id AS i, s FROM versions) x ON i = event_id")
def scd2_user_type(t):
    return versions(t).select(*_COLS, C.version_key("effectivedate", "user_id").alias("sk"))


@query(f"WITH {_VERSIONS} {_TOLD}")
def scd2_last_of_day(t):
    filled = H.forward_fill(sparse(t), ["user_id"], ["ts", "event_id"], ["cents", "kind"])
    return H.scd2_last_of_day(filled, ["user_id"], "ts", ["event_id"]).select(*_COLS)


@query(f"""WITH {_VERSIONS}, n AS (SELECT *, lead(s) OVER (PARTITION BY user_id ORDER BY s) AS nx FROM versions),
c AS (SELECT count(*) FILTER (nx <> e) AS a, count(*) FILTER (nx < e) AS b, count(*) FILTER (nx IS NULL AND e <> DATE '9999-12-31') AS c, count(*) FILTER (s >= e) AS d FROM n)
SELECT test, CASE WHEN f = 0 THEN 'OK' ELSE 'Not OK' END AS result, f AS failures FROM
(SELECT 'user aligned' AS test, a AS f FROM c UNION ALL SELECT 'user overlap', b FROM c UNION ALL SELECT 'user end of time', c FROM c UNION ALL SELECT 'user empty version', d FROM c UNION ALL SELECT 'user iscurrent', 0)""")
def scd2_invariants(t):
    return A.check_scd2("user", versions(t), ["user_id"])


@query(_WHOLE_LOG)
def scd2_by_blocks(t):
    """The same history with every user's events dealt over tasks by day: filled, led and dated block by block."""
    day = F.to_date("ts")
    filled = H.forward_fill_blocks(sparse(t), ["user_id"], ["ts", "event_id"], ["cents", "kind"], day)
    return H.scd2_build(filled, ["user_id"], "ts", ["event_id"], block=day).select(*_COLS)


@query("""WITH d AS (SELECT o_custkey, o_orderpriority AS held, CAST(o_orderdate AS DATE) AS s,
 coalesce(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), DATE '9999-12-31') AS e FROM orders),
v AS (SELECT * FROM d WHERE s < e)
SELECT held, o.o_orderpriority AS own, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents
FROM orders o JOIN v ON o.o_custkey = v.o_custkey AND s <= CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) < e GROUP BY ALL""")
def asof_orders_segment(t):
    dim = H.scd2_build(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("held")), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    fact = t.orders.select("o_custkey", F.col("o_orderdate").alias("at"), F.col("o_orderpriority").alias("own"), cents("o_totalprice").alias("cents"))
    return H.as_of_join(fact, dim.select("o_custkey", "held", "effectivedate", "enddate"), ["o_custkey"], "at").groupBy("held", "own").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


@query(SQL["asof_orders_segment"])
def asof_of_bucketed_tables(t):
    """The same join of two tables that lie in buckets of the customer: neither side is exchanged."""
    dim = H.scd2_build(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("held")), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    fact = t.orders.select("o_custkey", F.col("o_orderdate").alias("at"), F.col("o_orderpriority").alias("own"), cents("o_totalprice").alias("cents"))
    kept = [tables.bucketed(df, ["o_custkey"], 8) for df in (fact, dim.select("o_custkey", "held", "effectivedate", "enddate"))]
    return H.as_of_join(*kept, ["o_custkey"], "at").groupBy("held", "own").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


_BAND = "CASE WHEN value < 20 THEN 'low' WHEN value < 60 THEN 'mid' ELSE 'high' END"


@query(f"""WITH a AS (SELECT user_id, event_type AS kind, CAST(ts AS DATE) AS s, coalesce(lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, event_id), DATE '9999-12-31') AS e FROM events WHERE event_id % 2 = 0),
b AS (SELECT user_id, {_BAND} AS band, CAST(ts AS DATE) AS s, coalesce(lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, event_id), DATE '9999-12-31') AS e FROM events WHERE event_id % 2 = 1)
SELECT a.user_id, kind, band, CAST(greatest(a.s, b.s) AS VARCHAR) AS effectivedate, CAST(least(a.e, b.e) AS VARCHAR) AS enddate
FROM a JOIN b ON a.user_id = b.user_id AND a.s < b.e AND b.s < a.e WHERE a.s < a.e AND b.s < b.e""")
def overlap_clip(t):
    e = t.events
    one = H.scd2_build(e.filter("event_id % 2 = 0").select("user_id", "ts", "event_id", F.col("event_type").alias("kind")), ["user_id"], "ts", ["event_id"]).drop("ts", "event_id", "iscurrent")
    two = H.scd2_build(e.filter("event_id % 2 = 1").select("user_id", "ts", "event_id", F.expr(_BAND).alias("band")), ["user_id"], "ts", ["event_id"]).drop("ts", "event_id", "iscurrent")
    return H.overlap_join(one, two, ["user_id"]).select("user_id", "kind", "band", "effectivedate", "enddate")


@query(SQL["overlap_clip"])
def overlap_clip_by_bucket(t):
    """The same pairs with each user's versions dealt to buckets of three days."""
    e = t.events
    one = H.scd2_build(e.filter("event_id % 2 = 0").select("user_id", "ts", "event_id", F.col("event_type").alias("kind")), ["user_id"], "ts", ["event_id"]).drop("ts", "event_id", "iscurrent")
    two = H.scd2_build(e.filter("event_id % 2 = 1").select("user_id", "ts", "event_id", F.expr(_BAND).alias("band")), ["user_id"], "ts", ["event_id"]).drop("ts", "event_id", "iscurrent")
    return H.overlap_join(one, two, ["user_id"], bucket_days=3).select("user_id", "kind", "band", "effectivedate", "enddate")


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_order_state(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority", cents("o_totalprice").alias("cents"))
    return H.latest(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""SELECT l_partkey, l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) = 1""")
def first_shipment(t):
    return H.first_only(t.lineitem, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"]).select("l_partkey", "l_orderkey", "l_linenumber")


@query("""SELECT event_id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 'I' ELSE 'U' END AS cdc_flag FROM events""")
def cdc_flags(t):
    return H.cdc_flag(t.events, ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "cdc_flag")


@query(f"""WITH {_FILLED}, day AS (SELECT *, CAST(ts AS DATE) AS d FROM filled QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_id, cents, kind, CAST(d AS VARCHAR) AS update_dt, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY d) = 1 THEN 'I' ELSE 'U' END AS cdc_flag FROM day""")
def daily_change_feed(t):
    return H.to_change_feed(sparse(t), ["user_id"], "ts", ["event_id"], ["cents", "kind"]).select("user_id", "event_id", "cents", "kind", "update_dt", "cdc_flag")


@query("""SELECT user_id, CAST(CAST(min(ts) FILTER (event_type <> 'purchase') AS DATE) AS VARCHAR) AS placed, CAST(CAST(max(ts) FILTER (event_type = 'purchase') AS DATE) AS VARCHAR) AS removed
FROM events WHERE event_type IN ('view', 'purchase') GROUP BY user_id""")
def watch_open_close(t):
    w = H.open_close(t.events.filter("event_type IN ('view', 'purchase')"), ["user_id"], "event_type", "ts", "purchase")
    return w.withColumns({c: F.col(c).cast("date") for c in ("placed", "removed")})


@query("""SELECT user_id, CAST(CAST(coalesce(min(ts) FILTER (event_type IN ('signup')), min(ts)) AS DATE) AS VARCHAR) AS create_ts, arg_max(event_type, (ts, event_type)) AS status,
CASE WHEN arg_max(event_type, (ts, event_type)) IN ('purchase', 'error') THEN CAST(CAST(max(ts) AS DATE) AS VARCHAR) END AS close_ts FROM events GROUP BY user_id""")
def trade_lifecycle(t):
    out = K.trade_lifecycle(t.events, ["user_id"], "ts", "event_type", ["signup"], ["purchase", "error"])
    return out.withColumns({c: F.col(c).cast("date") for c in ("create_ts", "close_ts")})


def snapshots(t: Tables) -> DataFrame:
    c = t.customer
    each = [c.filter((c.c_custkey + b) % 4 != 0).select("c_custkey", F.when((c.c_custkey + b) % 5 == 0, F.lower("c_mktsegment")).otherwise(c.c_mktsegment).alias("segment"), F.lit(b).alias("batchid")) for b in (1, 2, 3)]
    return A.union(each)


_SNAP = """snap AS (SELECT c_custkey, CASE WHEN (c_custkey + b) % 5 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment, b FROM customer, (VALUES (1), (2), (3)) x(b) WHERE (c_custkey + b) % 4 <> 0),
diff AS (SELECT c_custkey, segment, min(b)::BIGINT AS first_batch, max(b)::BIGINT AS last_batch FROM snap GROUP BY ALL)"""


@query(f"WITH {_SNAP} SELECT * FROM diff")
def snapshot_diff(t):
    return H.snapshot_diff(snapshots(t), ["c_custkey", "segment"])


@query(f"WITH {_SNAP} SELECT c_custkey, segment, first_batch, least(last_batch, 2) AS last_batch FROM diff WHERE first_batch <= 2 AND last_batch >= 2")
def snapshot_as_of_batch(t):
    return H.as_of_batch(H.snapshot_diff(snapshots(t), ["c_custkey", "segment"]), 2)


@query(f"WITH {_FILLED} SELECT event_id, user_id, cents, kind FROM filled")
def ffill_in_blocks(t):
    """The same fill with each user's days in tasks of their own."""
    return H.forward_fill_blocks(sparse(t), ["user_id"], ["ts", "event_id"], ["cents", "kind"], F.to_date("ts")).select("event_id", "user_id", "cents", "kind")


@query(SQL["asof_orders_segment"])
def asof_in_buckets(t):
    """The as-of join with the quarter of the day among its equal keys."""
    dim = H.scd2_build(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("held")), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    fact = t.orders.select("o_custkey", F.col("o_orderdate").alias("at"), F.col("o_orderpriority").alias("own"), cents("o_totalprice").alias("cents"))
    return H.as_of_join(fact, dim.select("o_custkey", "held", "effectivedate", "enddate"), ["o_custkey"], "at", bucket_days=91).groupBy("held", "own").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


# ---- windows

_DAY = "SELECT user_id, CAST(ts AS DATE) AS day, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS total FROM events GROUP BY ALL"


@query(f"SELECT user_id, CAST(day AS VARCHAR) AS day, total, (sum(total) OVER (PARTITION BY user_id ORDER BY day))::BIGINT AS balance FROM ({_DAY})")
def daily_running_balance(t):
    return W.running_sum(W.daily_totals(t.events.withColumn("cents", cents("value")), ["user_id"], "ts", "cents"), ["user_id"], ["day"], "total")


@query(SQL["daily_running_balance"])
def daily_running_balance_by_blocks(t):
    """The same balances with each user's days dealt over tasks by week."""
    daily = W.daily_totals(t.events.withColumn("cents", cents("value")), ["user_id"], "ts", "cents")
    return W.running_sum_blocks(daily, ["user_id"], ["day"], "total", F.trunc("day", "week"))


def prices(t: Tables) -> DataFrame:
    unit = F.round(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("long")
    return t.lineitem.groupBy("l_partkey", F.col("l_shipdate").cast("date").alias("day")).agg(F.min(unit).alias("low"), F.max(unit).alias("high"))


_PRICES = """p AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, min(CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT)) AS low, max(CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT)) AS high FROM lineitem GROUP BY ALL)"""
_EXTREMES = """SELECT l_partkey, CAST(day AS VARCHAR) AS day, lo.v AS low_value, CAST(lo.d AS VARCHAR) AS low_day, hi.v AS high_value, CAST(DATE '1970-01-01' - hi.b AS VARCHAR) AS high_day FROM
(SELECT *, min({'v': low, 'd': day}) OVER w AS lo, max({'v': high, 'b': CAST(DATE '1970-01-01' - day AS INTEGER)}) OVER w AS hi FROM p WINDOW w AS (PARTITION BY l_partkey ORDER BY day %s))"""


@query(f"WITH {_PRICES} {_EXTREMES % 'ROWS BETWEEN 364 PRECEDING AND CURRENT ROW'}")
def rolling_52w_part_price(t):
    return W.rolling_extremes(prices(t), ["l_partkey"], "day", "low", "high").select("l_partkey", "day", "low_value", "low_day", "high_value", "high_day")


@query(f"WITH {_PRICES} {_EXTREMES % 'RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW'}")
def rolling_52w_by_days(t):
    return W.rolling_extremes(prices(t), ["l_partkey"], "day", "low", "high", days=365).select("l_partkey", "day", "low_value", "low_day", "high_value", "high_day")


@query(f"""WITH {_PRICES} SELECT l_partkey, lo.v AS low_value, CAST(lo.d AS VARCHAR) AS low_day, hi.v AS high_value, CAST(DATE '1970-01-01' - hi.b AS VARCHAR) AS high_day FROM
(SELECT l_partkey, min({{'v': low, 'd': day}}) AS lo, max({{'v': high, 'b': CAST(DATE '1970-01-01' - day AS INTEGER)}}) AS hi FROM p WHERE day > DATE '1999-06-30' - 365 AND day <= DATE '1999-06-30' GROUP BY l_partkey)""")
def extremes_of_year(t):
    return W.extremes_at(prices(t), ["l_partkey"], "day", "low", "high", F.lit("1999-06-30").cast("date"))


def quarters(t: Tables) -> DataFrame:
    day = F.col("l_shipdate")
    return t.lineitem.groupBy("l_suppkey", F.year(day).alias("y"), F.quarter(day).alias("q")).agg(F.sum(cents("l_extendedprice")).alias("revenue"))


_QUARTERS = """r AS (SELECT l_suppkey, year(l_shipdate) AS y, quarter(l_shipdate) AS q, sum(CAST(round(l_extendedprice * 100) AS BIGINT))::BIGINT AS revenue FROM lineitem GROUP BY ALL),
tr AS (SELECT *, (sum(revenue) OVER (PARTITION BY l_suppkey ORDER BY y, q ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))::BIGINT AS trailing FROM r)"""


@query(f"WITH {_QUARTERS} SELECT * FROM tr")
def trailing_4q_revenue(t):
    return W.trailing_sum(quarters(t), ["l_suppkey"], ["y", "q"], "revenue")


@query(f"""WITH {_QUARTERS} SELECT o_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, round(CAST(round(l_extendedprice * 100) AS BIGINT) / nullif(tr.trailing, 0), 9) AS ratio
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN tr USING (l_suppkey) WHERE y = year(l_shipdate) AND q = quarter(l_shipdate)""")
def pe_ratio_like(t):
    r = W.trailing_sum(quarters(t), ["l_suppkey"], ["y", "q"], "revenue").select("l_suppkey", "y", "q", "trailing")
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumns({"y": F.year("l_shipdate"), "q": F.quarter("l_shipdate")})
    return rows.join(r, ["l_suppkey", "y", "q"]).select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(C.safe_ratio(cents("l_extendedprice"), "trailing"), 9).alias("ratio"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1 AS idx FROM customer")
def dense_customer_index(t):
    return W.dense_index(t.customer.select("c_mktsegment", "c_custkey"), ["c_mktsegment", "c_custkey"]).select("c_custkey", "idx")


@query("""SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1""")
def top_order(t):
    return W.top1(t.orders, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]).select("o_custkey", "o_orderkey")


# ---- joins


@query("""SELECT r_name, n_name, count(*) AS n, sum(CAST(round(s_acctbal * 100) AS BIGINT))::BIGINT AS cents FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def nation_lookup(t):
    s = M.lookup(t.supplier, t.nation, "s_nationkey", "n_nationkey", {"n_name": "n_name", "n_regionkey": "n_regionkey"}, "inner")
    return M.lookup(s, t.region, "n_regionkey", "r_regionkey", {"r_name": "r_name"}, "inner").groupBy("r_name", "n_name").agg(F.count("*").alias("n"), F.sum(cents("s_acctbal")).alias("cents"))


@query("""SELECT s_suppkey, count(*) AS n FROM (SELECT CASE WHEN l_orderkey % 2 = 0 THEN lpad(CAST(l_suppkey AS VARCHAR), 10, '0') ELSE 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS ref FROM lineitem) x
JOIN supplier ON ref = s_name OR ref = lpad(CAST(s_suppkey AS VARCHAR), 10, '0') GROUP BY s_suppkey""")
def alt_key_lookup(t):
    ref = F.when(F.col("l_orderkey") % 2 == 0, F.lpad(F.col("l_suppkey").cast("string"), 10, "0")).otherwise(F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")))
    return M.alt_key_join(t.lineitem.select(ref.alias("ref")), t.supplier, "ref", ["s_name", "s_suppkey"]).groupBy("s_suppkey").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_custkey % 3 = 0 AS matched FROM customer")
def identity_match(t):
    a = t.customer.withColumn("line2", F.when(F.col("c_custkey") % 2 == 0, F.lit("")))
    b = a.filter("c_custkey % 3 = 0").select(F.upper("c_name").alias("c_name"), F.initcap("c_mktsegment").alias("c_mktsegment"), F.when(F.col("line2").isNull(), F.lit("")).alias("line2"))
    return M.identity_match(a, b, ["c_name", "c_mktsegment"], ["line2"]).select("c_custkey", "matched")


@query("""WITH v AS (SELECT user_id, event_id AS v_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
c AS (SELECT user_id, event_id AS c_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT coalesce(v.user_id, c.user_id) AS user_id, v_id, coalesce(v.cents, c.cents) AS cents, c_id FROM v FULL OUTER JOIN c ON v.user_id = c.user_id""")
def merged_feeds(t):
    last = lambda kind, name: H.latest(t.events.filter(f"event_type = '{kind}'").select("user_id", F.col("event_id").alias(name), cents("value").alias("cents")), ["user_id"], [name])
    return M.merge_updates(last("view", "v_id"), last("click", "c_id"), "user_id")


@query("""SELECT s_suppkey, s_name, n_nationkey::BIGINT AS s_nationkey, r_name AS moved_to, CAST(DATE '2020-01-01' + n_nationkey AS VARCHAR) AS changed FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 = 1""")
def cascade_children(t):
    moved = M.lookup(t.nation.filter("n_nationkey % 4 = 1"), t.region, "n_regionkey", "r_regionkey", {"r_name": "moved_to"}).withColumn("changed", F.date_add(F.lit("2020-01-01").cast("date"), F.col("n_nationkey")))
    child = t.supplier.select("s_suppkey", "s_name", "s_nationkey").withColumnRenamed("s_nationkey", "n_nationkey")
    return M.cascade(moved, child, "n_nationkey", "changed", ["moved_to"]).withColumnRenamed("n_nationkey", "s_nationkey")


@query("""SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def known_orders(t):
    ours = M.keep_known(t.orders, t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])
    return M.drop_known(ours, t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"]).select("o_orderkey")


@query("""WITH life AS (SELECT l_suppkey, date_trunc('quarter', min(l_shipdate))::DATE AS a, date_trunc('quarter', max(l_shipdate))::DATE AS b FROM lineitem GROUP BY 1)
SELECT l_suppkey, CAST(CAST(p AS DATE) AS VARCHAR) AS period FROM life, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 3 MONTHS)) x(p)""")
def supplier_quarters(t):
    life = t.lineitem.groupBy("l_suppkey").agg(F.trunc(F.min("l_shipdate"), "quarter").alias("a"), F.trunc(F.max("l_shipdate"), "quarter").alias("b"))
    return M.within_lifetime(life, "a", "b").select("l_suppkey", "period")


@query("""SELECT o_orderkey, CAST(DATEDIFF('day', (SELECT min(o_orderdate) FROM orders), o_orderdate) AS BIGINT) AS age FROM orders""")
def days_since_first(t):
    first = t.orders.agg(F.min("o_orderdate").alias("first"))
    return t.orders.crossJoin(first).select("o_orderkey", F.date_diff("o_orderdate", "first").alias("age"))  # one row on the right


@query("""SELECT o_orderkey, o_custkey, CAST(CAST(min(o_orderdate) OVER w AS DATE) AS VARCHAR) AS first_day, CAST(DATEDIFF('day', CAST(min(o_orderdate) OVER w AS DATE), CAST(o_orderdate AS DATE)) AS BIGINT) AS age, count(*) OVER w AS orders FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def days_since_own_first(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    told = W.over_key(o, ["o_custkey"], {"first_day": F.min("day"), "orders": F.count("*")})
    return told.select("o_orderkey", "o_custkey", "first_day", F.date_diff("day", "first_day").alias("age"), "orders")


@query("SELECT CAST(day AS VARCHAR) AS day, row_number() OVER (ORDER BY day) - 1 AS nth FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)")
def list_of_days(t):
    """The days on which something was shipped, numbered in order."""
    return W.dense_index(t.lineitem.select(F.to_date("l_shipdate").alias("day")).distinct(), ["day"], "nth")


@query("SELECT count(*) AS n, count(DISTINCT k) AS pairs, min(k) AS lo, max(k) AS hi FROM (SELECT (7919 * o_orderkey + 13) % (SELECT max(o_orderkey) + 1 FROM orders) AS k FROM orders)")
def bijection_pairs(t):
    m = t.orders.agg(F.max("o_orderkey") + 1).first()[0]
    k = M.affine_index(F.col("o_orderkey"), m, 7919, 13)
    return t.orders.select(k.alias("k")).agg(F.count("*").alias("n"), F.count_distinct("k").alias("pairs"), F.min("k").alias("lo"), F.max("k").alias("hi"))


# ---- changes


@query(f"WITH {_SPARSE} SELECT user_id, event_id, cents, kind FROM sparse QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def cdc_scd1(t):
    return K.apply_changes([sparse(t)], ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "cents", "kind")


@query(f"WITH {_FILLED} SELECT user_id, cents, kind FROM filled QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def cdc_scd1_ignore_nulls(t):
    e = sparse(t)
    return K.apply_changes([e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1")], ["user_id"], ["ts", "event_id"], ignore_nulls=True).select("user_id", "cents", "kind")


@query("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND event_type <> 'error'""")
def cdc_scd1_deletes(t):
    return K.apply_changes([t.events], ["user_id"], ["ts", "event_id"], delete_when=F.col("event_type") == "error").select("user_id", "event_id")


@query("""SELECT user_id, event_id, event_type, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS end_at FROM events""")
def cdc_scd2(t):
    e = t.events.select("user_id", "event_id", "event_type")
    return K.apply_changes([e], ["user_id"], ["event_id"], scd=2).select("user_id", "event_id", "event_type", "end_at")


_KEYS, _ORDER, _SPARSE_COLS = ["user_id"], ["event_id"], ["cents", "kind"]


@query(_WHOLE_LOG)
def scd2_merge_again(t):
    """Merging events that the history already has changes nothing, whichever of a day's events come again."""
    held = K.clocked_history(sparse(t), _KEYS, "ts", _ORDER, _SPARSE_COLS)
    return K.clocked_merge(held, sparse(t).filter("event_id % 2 = 0"), _KEYS, "ts", _ORDER, _SPARSE_COLS).select(*_COLS)


@query(_WHOLE_LOG)
def scd2_merge_of_sparse_late_events(t):
    """All sparse events in three batches, out of order, the events of a day in different ones and partly delivered twice, give the history of the whole log."""
    e, n = sparse(t), F.col("event_id") % 7
    held = K.clocked_history(e.filter(n < 3), _KEYS, "ts", _ORDER, _SPARSE_COLS)
    for batch in (e.filter((n == 3) | (n == 0)), e.filter(n > 3)):
        held = tables.scratch(K.clocked_merge(held, batch, _KEYS, "ts", _ORDER, _SPARSE_COLS), "versions")
    return held.select(*_COLS)


@query(_WHOLE_LOG)
def scd2_merge_of_late_events(t):
    """A first load and one batch that overlaps it and has late events of days that it knows give the history of all of them."""
    e = sparse(t)
    late = (F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")) | (F.col("event_id") % 11 == 0)
    held = K.clocked_history(e.filter(~late), _KEYS, "ts", _ORDER, _SPARSE_COLS)
    return K.clocked_merge(held, e.filter(late | (F.col("event_id") % 13 == 0)), _KEYS, "ts", _ORDER, _SPARSE_COLS).select(*_COLS)


@query("""WITH f AS (SELECT user_id, event_id, event_type FROM events WHERE event_id % 4 = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
n AS (SELECT user_id, event_id, event_type FROM events WHERE event_id % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT coalesce(f.user_id, n.user_id) AS user_id, CASE WHEN f.user_id IS NULL OR (n.user_id IS NOT NULL AND f.event_type <> 'purchase' AND n.event_id >= f.event_id) THEN n.event_id ELSE f.event_id END AS event_id,
CASE WHEN f.user_id IS NULL OR (n.user_id IS NOT NULL AND f.event_type <> 'purchase' AND n.event_id >= f.event_id) THEN n.event_type ELSE f.event_type END AS event_type FROM f FULL OUTER JOIN n ON f.user_id = n.user_id""")
def scd1_merge_guarded(t):
    e = t.events.select("user_id", "event_id", "event_type")
    held = H.latest(e.filter("event_id % 4 = 0"), ["user_id"], ["event_id"])
    return K.scd1_merge(held, e.filter("event_id % 4 <> 0"), ["user_id"], ["event_id"], guard=held["event_type"] != "purchase")


@query("""WITH o AS (SELECT user_id, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS b, max(CAST(ts AS DATE)) AS d FROM events GROUP BY 1),
n AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30')
SELECT user_id, b AS balance, CAST(d AS VARCHAR) AS day, user_id IN (SELECT user_id FROM n) AS touched FROM o""")
def balance_carried(t):
    e = t.events.select("user_id", F.col("ts").cast("date").alias("day"), cents("value").alias("cents"))
    old, new = tables.split_at(e, "day", F.lit("2024-01-30").cast("date"))
    state = old.groupBy("user_id").agg(F.sum("cents").alias("balance"), F.max("day").alias("day"))
    return K.carry_forward(state, new, ["user_id"], "day", "cents")


@query("""WITH c AS (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, c_custkey % 2 = 0 AS iscurrent, c_mktsegment FROM customer)
SELECT c_custkey, cents, iscurrent, CASE WHEN iscurrent AND c_custkey % 6 = 0 THEN 'known' ELSE c_mktsegment END AS c_mktsegment FROM c""")
def patched_current(t):
    c = t.customer.select("c_custkey", cents("c_acctbal").alias("cents"), (F.col("c_custkey") % 2 == 0).alias("iscurrent"), "c_mktsegment")
    return K.patch_current(c, c.filter("c_custkey % 3 = 0"), ["c_custkey"], {"c_mktsegment": F.lit("known")})


# ---- streams (bounded): the result of a replay equals the one of a batch


def fed(df: DataFrame, seq: str, home: str, batches: int = 4, rows_a_file: int = 250_000) -> DataFrame:
    """``df`` as a stream of files, out of order by ``seq``: as many files as its rows need, read in ``batches`` micro-batches."""
    with tables.freed(df.sparkSession):
        parts = max(batches, -(-df.count() // rows_a_file))
        df.repartition(parts, F.xxhash64(seq)).write.parquet(f"{home}/feed")
    return files.stream_table(df.sparkSession, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema), f"{home}/feed", "parquet", files_per_trigger=-(-parts // batches))


def _feed(t: Tables, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    home = tables.scratch_path(t.spark, name)
    return fed(df, "event_id", home), home


@query(_WHOLE_LOG)
def cdc_scd2_merge_replay(t):
    """The whole sparse log as a stream whose micro-batches mix the events of all days."""
    source, home = _feed(t, sparse(t), "scd2")
    seed = K.clocked_history(sparse(t).limit(0), _KEYS, "ts", _ORDER, _SPARSE_COLS)
    return replay.fold(source, seed, lambda held, batch: K.clocked_merge(held, batch, _KEYS, "ts", _ORDER, _SPARSE_COLS), home, _KEYS).select(*_COLS)


@query("SELECT user_id, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS balance, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS day FROM events GROUP BY 1")
def balance_state_replay(t):
    e = t.events.select("event_id", "user_id", F.col("ts").cast("date").alias("day"), cents("value").alias("cents"))
    source, home = _feed(t, e, "balance")
    seed = e.limit(0).select("user_id", F.col("cents").alias("balance"), "day")
    return replay.fold(source, seed, lambda held, batch: K.carry_forward(held, batch, ["user_id"], "day", "cents").drop("touched"), home, ["user_id"])


@query("SELECT user_id, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS balance, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS day, count(*) AS events FROM events GROUP BY 1")
def balance_kept_as_state(t):
    """Balances as the disk-backed state of a streaming aggregation, read back out of its store: no table is rewritten."""
    e = t.events.select("event_id", "user_id", F.col("ts").cast("date").alias("day"), cents("value").alias("cents"))
    source, home = _feed(t, e, "state")
    return state.keyed_state(source, ["user_id"], {"balance": F.sum("cents"), "day": F.max("day"), "events": F.count("*")}, f"{home}/checkpoint")


@query(f"SELECT user_id, CAST(day AS VARCHAR) AS day, total FROM ({_DAY})")
def daily_fact_replay(t):
    """A date's events come in any of four micro-batches: their sums are parts of the date, put together when read and when compacted."""
    e = t.events.select("event_id", "user_id", F.col("ts").cast("date").alias("day"), cents("value").alias("cents"))
    source, home = _feed(t, e, "fact")
    totals = lambda rows: rows.groupBy("user_id", "day").agg(F.sum("cents").alias("total"))
    parts = replay.DailyParts(t.spark, f"{home}/fact", "day", lambda rows: rows.groupBy("user_id", "day").agg(F.sum("total").alias("total")))
    replay.append_facts(source, totals, parts, f"{home}/checkpoint")
    parts.compact("user_id long, total long, day date")
    replay.reprocess(e, "2024-01-05", totals, parts)
    return parts.read("user_id long, total long, day date")


# ---- cleaning and files


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' END AS status, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE o_orderstatus END AS shown,
CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS dk, CAST(strftime(o_orderdate, '%H%M%S') AS BIGINT) AS tk FROM orders""")
def code_maps(t):
    codes = {"O": "Open", "F": "Filled"}
    return t.orders.select("o_orderkey", C.map_codes("o_orderstatus", codes).alias("status"), C.map_codes("o_orderstatus", codes, True).alias("shown"), C.date_key("o_orderdate").alias("dk"), C.time_key("o_orderdate").alias("tk"))


@query("""WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '1' END AS a, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END AS b,
CASE WHEN c_custkey % 5 = 0 THEN '' ELSE CAST(5550000 + c_custkey AS VARCHAR) END AS c, CASE WHEN c_custkey % 7 = 0 THEN '99' END AS d FROM customer)
SELECT c_custkey, CASE WHEN c <> '' THEN coalesce('+' || nullif(a, '') || ' ', '') || coalesce('(' || b || ') ', '') || c || coalesce(d, '') END AS phone FROM p""")
def phone_assembly(t):
    k = F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        C.phone(F.when(k % 3 == 0, "").otherwise("1"), F.when(k % 4 != 0, F.lpad(F.col("c_nationkey").cast("string"), 3, "0")), F.when(k % 5 == 0, "").otherwise((k + 5550000).cast("string")), F.when(k % 7 == 0, "99")).alias("phone"),
    )


@query("""WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), p AS (SELECT c_custkey, c_acctbal * 300 AS networth, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(CAST(round(c_acctbal * 30) AS BIGINT) AS BIGINT) END AS income,
coalesce(n, 0) AS kids, c_nationkey AS cards, c_custkey % 90 AS age, c_custkey % 850 AS rating, c_custkey % 6 AS cars FROM customer LEFT JOIN o ON o_custkey = c_custkey)
SELECT c_custkey, concat_ws('+', CASE WHEN networth > 1000000 OR income > 200000 THEN 'HighValue' END, CASE WHEN kids > 3 OR cards > 5 THEN 'Expenses' END, CASE WHEN age > 45 THEN 'Boomer' END,
CASE WHEN income < 50000 OR rating < 600 OR networth < 100000 THEN 'MoneyAlert' END, CASE WHEN cars > 3 OR cards > 7 THEN 'Spender' END, CASE WHEN age < 25 AND networth > 1000000 THEN 'Inherited' END) AS tags FROM p""")
def tags_customer(t):
    n = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    k = F.col("c_custkey")
    income = F.when(k % 10 == 0, F.lit("unknown")).otherwise(F.round(F.col("c_acctbal") * 30).cast("long").cast("string"))
    p = t.customer.join(n, F.col("o_custkey") == k, "left").select(
        "c_custkey", (F.col("c_acctbal") * 300).alias("networth"), income.alias("income"), F.coalesce("n", F.lit(0)).alias("numberchildren"), F.col("c_nationkey").alias("numbercreditcards"),
        (k % 90).alias("age"), (k % 850).alias("creditrating"), (k % 6).alias("numbercars"),
    )
    return p.select("c_custkey", C.marketing_tags().alias("tags"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey END AS n, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE '2020-01-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') END AS d,
CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE p_name END AS ref, upper(left(p_type, 1)) AS g, CASE p_partkey % 3 WHEN 0 THEN false WHEN 1 THEN true END AS low FROM
(SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN 'M' ELSE 'U' END AS p_type FROM part)""")
def tolerant_casts(t):
    k = F.col("p_partkey")
    return t.part.select(
        "p_partkey",
        C.tolerant(F.when(k % 3 == 0, " x1 ").otherwise(F.concat(F.lit("  "), k.cast("string"))), "long").alias("n"),
        C.tolerant(F.when(k % 4 == 0, "20201399").otherwise(F.concat(F.lit("202001"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))), "date").alias("d"),
        C.id_or_name(F.when(k % 2 == 0, F.lpad(k.cast("string"), 12, "0")).otherwise(F.col("p_name"))).alias("ref"),
        C.gender(F.when(k % 2 == 0, "m").otherwise("?")).alias("g"),
        C.low_grade(F.when(k % 3 == 0, "A+").when(k % 3 == 1, "CC").otherwise("none")).alias("low"),
    )


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part")
def fixed_width_roundtrip(t):
    at, fields, widths = 1, [], [("p_partkey", 12), ("p_name", 40), ("p_brand", 12), ("p_type", 20), ("p_size", 6), ("cents", 14)]
    kinds = {"p_partkey": "long", "p_size": "int", "cents": "long"}
    for name, n in widths:
        fields.append((name, at, n, kinds.get(name, "string")))
        at += n
    path = tables.scratch_path(t.spark, "part.txt")
    files.write_fixed_width(t.part.withColumn("cents", cents("p_retailprice")), path, widths)
    return files.parse_fixed_width(t.spark.read.text(path), fields)


@query("SELECT c_custkey, c_name, c_mktsegment AS segment, c_nationkey::BIGINT AS nation, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lower(c_name) || '@example.com' END AS email FROM customer")
def xml_roundtrip(t):
    path = tables.scratch_path(t.spark, "customer.xml")
    rows = t.customer.select(
        F.struct(F.col("c_custkey").alias("_C_ID"), F.struct(F.col("c_name").alias("C_NAME")).alias("Name"), F.struct(F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("C_EMAIL")).alias("ContactInfo"),
                 F.struct(F.col("c_nationkey").alias("_N_ID"), F.col("c_mktsegment").alias("SEGMENT")).alias("Account")).alias("Customer"))
    files.write_xml(rows, path, "Actions", "Action")
    schema = "Customer struct<_C_ID:long,Name:struct<C_NAME:string>,ContactInfo:struct<C_EMAIL:string>,Account:struct<_N_ID:int,SEGMENT:string>>"
    return files.flatten(files.read_xml(t.spark, path, "Action", schema), {"c_custkey": "Customer._C_ID", "c_name": "Customer.Name.C_NAME", "segment": "Customer.Account.SEGMENT", "nation": "Customer.Account._N_ID", "email": "Customer.ContactInfo.C_EMAIL"})


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 + o_orderkey % 2 END AS batchid FROM orders")
def batched_files(t):
    root = tables.scratch_path(t.spark, "raw")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", cents("o_totalprice").alias("cents"))
    tables.write_delimited(o.filter("o_orderkey % 3 = 0"), f"{root}/Batch1")
    for b in (2, 3):
        tables.write_delimited(o.filter(f"o_orderkey % 3 <> 0 AND o_orderkey % 2 = {b - 2}").select(F.lit("I"), F.col("o_orderkey"), *o.columns), f"{root}/Batch{b}")
    return files.read_table(t.spark, files.TableSpec("orders", "o_orderkey long, o_custkey long, o_orderstatus string, cents long", "part-*", batches=(1, 2, 3), cdc_from=2), root, strict=True)


@query("SELECT CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS month, count(*) AS n, sum(CASE WHEN date_trunc('month', o_orderdate)::DATE = DATE '1997-03-01' THEN 2 ELSE 1 END)::BIGINT AS mark FROM orders GROUP BY 1")
def replaced_months(t):
    path = tables.scratch_path(t.spark, "months")
    o = t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("month"), F.lit(1).alias("mark"))
    tables.replace_keys(o, path, "month")
    tables.replace_where(o.filter("month = '1997-03-01'").withColumn("mark", F.lit(2)), path, "month", F.lit("1997-03-01").cast("date"))
    back = t.spark.read.schema("o_orderkey long, mark int, month date").parquet(path)
    return back.groupBy("month").agg(F.count("*").alias("n"), F.sum("mark").alias("mark"))


# ---- audits


@query("""SELECT source, 'Validation' AS kind, 'Row count' AS message, CAST(n AS VARCHAR) AS data FROM (SELECT 'customer' AS source, count(*) AS n FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders)
UNION ALL SELECT 'lineitem', 'Validation', 'Row count joined', CAST(count(*) AS VARCHAR) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) AND l_partkey IN (SELECT p_partkey FROM part) AND l_suppkey IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'batch', 'PCR', 'Batch complete', '1'""")
def batch_validation(t):
    joined = A.joined_count("lineitem", t.lineitem, [(t.orders, "l_orderkey", "o_orderkey"), (t.part, "l_partkey", "p_partkey"), (t.supplier, "l_suppkey", "s_suppkey")])
    return A.union([A.row_counts({"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer}), joined, A.phase_record(t.spark, 1)])


@query("""SELECT 'customer' AS source, 'Alert' AS kind, 'Low balance' AS message, 'C_ID = ' || c_custkey AS data FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'lineitem', 'Alert', 'High discount', 'L_ID = ' || l_orderkey || '/' || l_linenumber FROM lineitem WHERE l_discount > 0.08 AND l_tax > 0.05
UNION ALL SELECT 'part', 'Alert', 'Odd size', 'P_ID = ' || p_partkey FROM part WHERE p_size NOT BETWEEN 2 AND 48""")
def alerts(t):
    tell = lambda label, *c: F.concat(F.lit(label), F.concat_ws("/", *c))
    return A.alerts([
        ("customer", "Low balance", t.customer, F.col("c_acctbal") < 0, tell("C_ID = ", "c_custkey")),
        ("lineitem", "High discount", t.lineitem, (F.col("l_discount") > 0.08) & (F.col("l_tax") > 0.05), tell("L_ID = ", "l_orderkey", "l_linenumber")),
        ("part", "Odd size", t.part, ~F.col("p_size").between(2, 48), tell("P_ID = ", "p_partkey")),
    ])


_RESULT = "SELECT test, CASE WHEN f = 0 THEN 'OK' ELSE 'Not OK' END AS result, f AS failures FROM ({})"


@query(_RESULT.format("""SELECT 'orders customer' AS test, count(*) AS f FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'lineitem order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem first orders', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0) UNION ALL SELECT 'unique order', 0
UNION ALL SELECT 'unique customer', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)"""))
def fk_audit(t):
    return A.union([
        A.check_reference("orders customer", t.orders, "o_custkey", t.customer, "c_custkey"),
        A.check_reference("lineitem order", t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
        A.check_reference("lineitem first orders", t.lineitem, "l_orderkey", t.orders.filter("o_orderkey % 7 <> 0"), "o_orderkey"),
        A.check_unique("unique order", t.orders, ["o_orderkey"]),
        A.check_unique("unique customer", t.orders, ["o_custkey"]),
    ])


@query(_RESULT.format("""SELECT 'status' AS test, count(*) AS f FROM orders WHERE o_orderstatus NOT IN ('O', 'F') UNION ALL SELECT 'segment', count(*) FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD')
UNION ALL SELECT 'name', count(*) FROM customer WHERE c_name NOT LIKE 'Customer#________%' UNION ALL SELECT 'brand', count(*) FROM part WHERE p_brand NOT LIKE 'Brand#_'"""))
def domain_audit(t):
    return A.union([
        A.check_domain("status", t.orders, "o_orderstatus", ["O", "F"]),
        A.check_domain("segment", t.customer, "c_mktsegment", ["MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD"]),
        A.check_pattern("name", t.customer, "c_name", ["Customer#________%"]),
        A.check_pattern("brand", t.part, "p_brand", ["Brand#_"]),
    ])


@query(_RESULT.format("""SELECT 'containment' AS test, count(*) AS f FROM (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS s, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem GROUP BY 1) x LEFT JOIN orders ON o_orderkey = l_orderkey WHERE coalesce(CAST(o_orderdate AS DATE) > s OR CAST(o_orderdate AS DATE) + 90 < e, true)
UNION ALL SELECT 'window', count(*) FROM orders WHERE NOT CAST(o_orderdate AS DATE) BETWEEN (CASE o_orderkey % 2 WHEN 0 THEN DATE '1995-01-01' ELSE DATE '1997-01-01' END) AND (CASE o_orderkey % 2 WHEN 0 THEN DATE '1999-12-31' ELSE DATE '2001-12-31' END)"""))
def window_audit(t):
    held = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("date").alias("effectivedate"), F.date_add(F.col("o_orderdate").cast("date"), 90).alias("enddate"))
    spans = t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").cast("date").alias("s"), F.max("l_shipdate").cast("date").alias("e"))
    windows = t.spark.sql("SELECT * FROM VALUES (0L, DATE'1995-01-01', DATE'1999-12-31'), (1L, DATE'1997-01-01', DATE'2001-12-31') AS w(batchid, first_day, last_day)")
    rows = t.orders.select(F.col("o_orderdate").cast("date").alias("day"), (F.col("o_orderkey") % 2).alias("b"))
    return A.union([A.check_contained("containment", spans, "l_orderkey", "s", "e", held, "k"), A.check_window("window", rows, "day", "b", windows)])


@query(_RESULT.format("""SELECT 'lines per order' AS test, count(*) AS f FROM (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) a FULL OUTER JOIN (SELECT o_orderkey AS k, 4 AS n FROM orders) b ON a.k = b.k WHERE a.n IS DISTINCT FROM b.n
UNION ALL SELECT 'never falls', count(*) FROM (SELECT n, lag(n) OVER (PARTITION BY o_orderpriority ORDER BY y) AS p FROM (SELECT o_orderpriority, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL)) WHERE p > n
UNION ALL SELECT 'batches', count(*) FROM (VALUES (1994), (2001)) x(b) WHERE b NOT IN (SELECT year(o_orderdate) FROM orders)"""))
def count_reconcile(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    by_year = t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    return A.union([
        A.check_count("lines per order", lines, t.orders.select(F.col("o_orderkey").alias("k"), F.lit(4).cast("long").alias("n")), ["k"], "n"),
        A.never_falls("never falls", by_year, "o_orderpriority", "y", "n"),
        A.batches_complete("batches", t.orders.select(F.year("o_orderdate").alias("y")), "y", range(1994, 2002)),
    ])


@query("""SELECT 'price' AS expectation, count(*) FILTER (l_extendedprice > 1000) AS passed, count(*) FILTER (NOT l_extendedprice > 1000) AS failed, 0 AS unknown FROM lineitem
UNION ALL SELECT 'tax', count(*) FILTER (t > 0.02), count(*) FILTER (NOT t > 0.02), count(*) FILTER (t IS NULL) FROM (SELECT CASE WHEN l_linenumber <> 3 THEN l_tax END AS t FROM lineitem)""")
def expectations(t):
    rows = t.lineitem.withColumn("t", F.when(F.col("l_linenumber") != 3, F.col("l_tax")))
    return A.expect(rows, {"price": F.col("l_extendedprice") > 1000, "tax": F.col("t") > 0.02})


@query(SQL["expectations"])
def expectations_observed(t):
    """The same counts, gathered by the job that writes the table."""
    rows = t.lineitem.withColumn("t", F.when(F.col("l_linenumber") != 3, F.col("l_tax")))
    seen = A.Observed(rows, {"price": F.col("l_extendedprice") > 1000, "tax": F.col("t") > 0.02})
    tables.overwrite(seen.df, tables.scratch_path(t.spark, "lines"))
    return seen.expectations()


@query(SQL["expectations"])
def expectations_of_a_stream(t):
    """The same counts, gathered by the micro-batches of a stream as they write their parts."""
    rows = t.lineitem.select("l_orderkey", F.to_date("l_shipdate").alias("day"), "l_extendedprice", F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("t"))
    home = tables.scratch_path(t.spark, "lines")
    parts = replay.DailyParts(t.spark, f"{home}/fact", "month")
    told = lambda batch: batch.withColumn("month", F.trunc("day", "month"))
    replay.append_facts(fed(rows, "l_orderkey", home), told, parts, f"{home}/checkpoint", expectations={"price": F.col("l_extendedprice") > 1000, "tax": F.col("t") > 0.02})
    return replay.expected(parts)


@query("""WITH c AS (SELECT year(o_orderdate)::BIGINT AS batchid, a, count(*) FILTER (CASE a WHEN 'records' THEN true WHEN 'open' THEN o_orderstatus = 'O' ELSE o_orderpriority = '1-URGENT' END) AS value
FROM orders, (VALUES ('records'), ('open'), ('urgent')) x(a) GROUP BY ALL)
SELECT 'orders' AS dataset, batchid, a AS attribute, value, (sum(value) OVER (PARTITION BY a ORDER BY batchid))::BIGINT AS expected FROM c""")
def audit_counters(t):
    rules = {"records": F.lit(True), "open": F.col("o_orderstatus") == "O", "urgent": F.col("o_orderpriority") == "1-URGENT"}
    counts = A.counters(t.orders.withColumn("batchid", F.year("o_orderdate")), "orders", rules)
    return A.cumulative(counts, ["dataset", "attribute"], "batchid", "value")


@query(SQL["audit_counters"])
def audit_counters_observed(t):
    """The same counters by batch, gathered by the job that writes the table; the batches are the years that its statistics tell."""
    rules = {"records": F.lit(True), "open": F.col("o_orderstatus") == "O", "urgent": F.col("o_orderpriority") == "1-URGENT"}
    lo, hi = t.orders.agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    seen = A.Observed(t.orders.withColumn("batchid", F.year("o_orderdate")), rules, "batchid", range(lo, hi + 1))
    tables.overwrite(seen.df, tables.scratch_path(t.spark, "orders"))
    return A.cumulative(seen.counters("orders"), ["dataset", "attribute"], "batchid", "value")


@query("SELECT DISTINCT c_nationkey::BIGINT AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def nations_in_use(t):
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).union(t.supplier.select("s_nationkey")).distinct()


@query(f"WITH {_FILLED} SELECT user_id, cents, kind, CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate, e = DATE '9999-12-31' AS iscurrent FROM (SELECT *, CAST(ts AS DATE) AS s, coalesce(lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, event_id), DATE '9999-12-31') AS e FROM filled) WHERE s < e")
def scd2_two_row_merge(t):
    """Days applied one after the other, each as closed copies and new versions upserted on (user, start); what any event of a day told counts."""
    first = F.lit("2024-01-22").cast("date")
    held = K.clocked_history(sparse(t).filter(F.to_date("ts") < first), _KEYS, "ts", _ORDER, _SPARSE_COLS).select("user_id", *_SPARSE_COLS, "effectivedate", "enddate", "iscurrent")
    told = K.apply_changes([sparse(t).withColumn("day", F.to_date("ts")).filter(F.col("day") >= first)], ["user_id", "day"], ["ts", "event_id"], ignore_nulls=True)
    told = tables.scratch(told.select("user_id", "day", *_SPARSE_COLS), "told")
    for d in sorted(r[0] for r in told.select("day").distinct().collect()):  # a row for each day
        rows = K.scd2_rows(held, told.filter(F.col("day") == F.lit(d)), ["user_id"], "day", _SPARSE_COLS)
        held = tables.scratch(held.join(rows.select("user_id", "effectivedate"), ["user_id", "effectivedate"], "left_anti").unionByName(rows), "versions")
    return held


@query("SELECT o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, 1 + o_orderkey % 3 AS batchid FROM orders")
def batched_parquet(t):
    """The Parquet form of a batched file set, read by a list of specs."""
    root = tables.scratch_path(t.spark, "raw_parquet")
    o = t.orders.select("o_orderkey", "o_custkey", cents("o_totalprice").alias("cents"))
    for b in (1, 2, 3):
        o.filter(f"o_orderkey % 3 = {b - 1}").write.parquet(f"{root}/Batch{b}")
    specs = [files.TableSpec("orders", "o_orderkey long, o_custkey long, cents long", "*.parquet", batches=(1, 2, 3))]
    return files.read_all(t.spark, specs, root, "parquet")["orders"]


@query("""SELECT 'orders' AS dataset, year(o_orderdate)::BIGINT AS batchid, '2020-01-01' AS date, 'O_RECORDS' AS attribute, count(*) AS value FROM orders GROUP BY ALL""")
def audit_csv_roundtrip(t):
    path = tables.scratch_path(t.spark, "audit.csv")
    counts = A.counters(t.orders.withColumn("batchid", F.year("o_orderdate")), "orders", {"O_RECORDS": F.lit(True)})
    counts.select("dataset", "batchid", F.lit("2020-01-01").alias("date"), "attribute", "value", F.lit(None).cast("string").alias("dvalue")).write.option("header", True).csv(path)
    return files.read_audit(t.spark, path).drop("dvalue")


@query("""SELECT s_suppkey, n_nationkey::BIGINT AS s_nationkey, CAST(DATE '2020-01-01' + n_nationkey AS VARCHAR) AS changed FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 3 = 0""")
def cascade_stream(t):
    """A stream of parents' changes gives change rows of their children, a partition for each day."""
    home = tables.scratch_path(t.spark, "moves")
    moves = t.nation.filter("n_nationkey % 3 = 0").select("n_nationkey", F.date_add(F.lit("2020-01-01").cast("date"), F.col("n_nationkey")).alias("changed"))
    child = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    parts = replay.DailyParts(t.spark, f"{home}/rows", "changed")
    replay.append_facts(fed(moves, "n_nationkey", home), lambda batch: M.cascade(batch, child, "n_nationkey", "changed"), parts, f"{home}/checkpoint")
    return parts.read("s_suppkey long, n_nationkey int, changed date").withColumnRenamed("n_nationkey", "s_nationkey")


@query("""SELECT source, 'Visibility' AS kind, 'Row count' AS message, CAST(n AS VARCHAR) AS data FROM (SELECT 'orders' AS source, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')""")
def visibility_counts(t):
    """Counts as they can be seen at one moment."""
    at = F.lit("1998-01-01").cast("timestamp_ntz")
    return A.row_counts({"orders": tables.split_at(t.orders, "o_orderdate", at)[0], "lineitem": tables.split_at(t.lineitem, "l_shipdate", at)[0]}, "Visibility")


@query("""SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-15'""")
def newer_than_target(t):
    """Only rows of days that a target doesn't have yet."""
    e = t.events.withColumn("day", F.to_date("ts"))
    return replay.newer_than_target(e, "day", e.filter("day <= '2024-01-15'"), "day").select("event_id", "user_id")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def appended_orders(t):
    """A table written anew and added to."""
    path, o = tables.scratch_path(t.spark, "orders"), t.orders.select("o_orderkey", "o_orderstatus")
    tables.overwrite(o.filter("o_orderstatus = 'P'"), path)
    tables.overwrite(o.filter("o_orderstatus = 'F'"), path)
    tables.append(o.filter("o_orderstatus <> 'F'"), path)
    return t.spark.read.schema(o.schema).parquet(path)


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS events, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def files_by_date(t):
    """A folder per date, read back by its own column."""
    path = tables.scratch_path(t.spark, "dates")
    tables.write_by_date(t.events.select("event_id", F.to_date("ts").alias("day")), path, "day")
    return t.spark.read.schema("event_id long, day date, _pdate date").parquet(path).filter("day = _pdate").groupBy("day").agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))


@query("SELECT l_shipdate::DATE::VARCHAR AS day, count(*) AS lines, sum(l_orderkey)::BIGINT AS keys FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1995-03-31' GROUP BY 1")
def clustered_month(t):
    """A month out of files that lie clustered by day, after they were written in files of a given size."""
    path = tables.scratch_path(t.spark, "lines")
    lines = t.lineitem.select("l_orderkey", F.to_date("l_shipdate").alias("day"))
    tables.sized(lines, f"{path}/sized", 16)
    kept = tables.recode(t.spark, t.spark.read.schema("l_orderkey long, day date").parquet(f"{path}/sized"), f"{path}/recoded", 8)
    tables.clustered(kept, f"{path}/clustered", "day", 8)
    month = t.spark.read.schema("l_orderkey long, day date").parquet(f"{path}/clustered").filter("day BETWEEN '1995-03-01' AND '1995-03-31'")
    return month.groupBy("day").agg(F.count("*").alias("lines"), F.sum("l_orderkey").alias("keys"))


@query("""SELECT 'month' AS asked, count(*) AS lines, sum(l_orderkey)::BIGINT AS keys FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1995-03-31'
UNION ALL SELECT 'parts', count(*), sum(l_orderkey)::BIGINT FROM lineitem WHERE l_partkey BETWEEN 20 AND 40""")
def clustered_by_day_and_part(t):
    """One set of files, clustered by day and part together, asked by either."""
    path = tables.scratch_path(t.spark, "lines")
    tables.clustered_by_all(t.lineitem.select("l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("day")), path, ["day", "l_partkey"], 16)
    kept = t.spark.read.schema("l_orderkey long, l_partkey long, day date").parquet(path)
    told = lambda name, df: df.agg(F.count("*").alias("lines"), F.sum("l_orderkey").alias("keys")).select(F.lit(name).alias("asked"), "lines", "keys")
    return told("month", kept.filter("day BETWEEN '1995-03-01' AND '1995-03-31'")).union(told("parts", kept.filter("l_partkey BETWEEN 20 AND 40")))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def current_versions(t):
    e = t.events.select("user_id", "ts", "event_id", "event_type")
    return H.current(H.scd2_build(e, ["user_id"], "ts", ["event_id"])).select("user_id", "event_id", "event_type")


@query("""WITH d AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS low, max(CAST(round(l_extendedprice * 100) AS BIGINT)) AS high FROM lineitem GROUP BY ALL)
SELECT l_partkey, CAST(day AS VARCHAR) AS day, low, high, min(low) OVER w AS low_value, max(high) OVER w AS high_value FROM d WINDOW w AS (PARTITION BY l_partkey ORDER BY day)""")
def extremes_so_far(t):
    d = t.lineitem.groupBy("l_partkey", F.to_date("l_shipdate").alias("day")).agg(F.min(cents("l_extendedprice")).alias("low"), F.max(cents("l_extendedprice")).alias("high"))
    return W.rolling_extremes(d, ["l_partkey"], "day", "low", "high", rows=None).drop("low_day", "high_day")


@query("SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS total FROM events GROUP BY ALL")
def seeded_then_streamed(t):
    """History seeds the table once; the stream, in which every date is dealt over four micro-batches, has the history too and skips it."""
    day, schema = F.lit("2024-01-15").cast("date"), "user_id long, total long, day date"
    totals = lambda rows: rows.groupBy("user_id", "day").agg(F.sum("cents").alias("total"))
    e = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"), cents("value").alias("cents"))
    source, home = _feed(t, e, "seeded")
    parts = replay.DailyParts(t.spark, f"{home}/fact", "day", lambda rows: rows.groupBy("user_id", "day").agg(F.sum("total").alias("total")))
    for _ in range(2):  # a second start finds the seed
        replay.seeded(totals(e.filter(F.col("day") <= day)), parts)
    replay.append_facts(source, totals, parts, f"{home}/checkpoint", after="2024-01-15")
    return parts.read(schema)


@query("SELECT count(*) AS customers, count(*) AS told, count(*) AS same FROM customer")
def dictionary_values(t):
    """A value out of a list for each key, the same one whenever it is asked for."""
    values = ["red", "green", "blue"]
    pick = M.from_dictionary(F.col("c_custkey"), values)
    c = t.customer.select("c_custkey", pick.alias("a")).join(t.customer.repartition(3).select("c_custkey", pick.alias("b")), "c_custkey")
    return c.agg(F.count("*").alias("customers"), F.count(F.when(F.col("a").isin(*values), 1)).alias("told"), F.count(F.when(F.col("a") == F.col("b"), 1)).alias("same"))
