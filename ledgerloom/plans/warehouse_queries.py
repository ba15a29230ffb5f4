"""Queries that load the warehouse from the derived feeds, each with SQL that goes straight from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import clean as C
from ledgerloom.operators import changes as K
from ledgerloom.operators import history as H
from ledgerloom.operators import windows as W
from ledgerloom.plans.queries import dated, fed
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.sources import files, tables
from ledgerloom.streaming import replay

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_END = "DATE '9999-12-31'"
_CTES = f"""WITH cust_log AS (
  SELECT c_custkey AS customerid, CAST(DATE '1994-01-01' + CAST(c_custkey % 300 AS INTEGER) AS TIMESTAMP) AS ts, -1 AS seq, 'NEW' AS action, c_name AS lastname, c_custkey % 3 + 1 AS tier,
    CASE c_custkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'F' ELSE 'x' END AS gender, c_mktsegment AS city, c_mktsegment AS first_city, c_nationkey AS nat_tx FROM customer
  UNION ALL SELECT o_custkey, o_orderdate, o_orderkey, CASE WHEN o_orderkey % 50 = 9 THEN 'INACT' ELSE 'UPDCUST' END, NULL, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 5 END, NULL,
    CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END, NULL, NULL FROM orders),
cust_f AS (SELECT customerid, action, CAST(ts AS DATE) AS s, coalesce(lead(CAST(ts AS DATE)) OVER o, {_END}) AS e, last_value(lastname IGNORE NULLS) OVER w AS lastname, last_value(tier IGNORE NULLS) OVER w AS tier,
    last_value(gender IGNORE NULLS) OVER w AS gender, last_value(city IGNORE NULLS) OVER w AS city, last_value(first_city IGNORE NULLS) OVER w AS first_city, last_value(nat_tx IGNORE NULLS) OVER w AS nat_tx
  FROM cust_log WINDOW w AS (PARTITION BY customerid ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), o AS (PARTITION BY customerid ORDER BY ts, seq)),
cust AS (SELECT *, CAST(strftime(s, '%Y%m%d') || customerid AS BIGINT) AS sk_customerid FROM cust_f WHERE s < e),
acct_log AS (
  SELECT c_custkey * 10 AS accountid, c_custkey AS customerid, CAST(DATE '1994-01-01' + CAST(c_custkey % 300 AS INTEGER) AS TIMESTAMP) AS ts, -1 AS seq, 'Active' AS status, c_custkey % 7 AS brokerid FROM customer
  UNION ALL SELECT o_custkey * 10, o_custkey, o_orderdate, o_orderkey, CASE WHEN o_orderkey % 40 = 1 THEN 'Inactive' END, CASE WHEN o_orderkey % 8 = 1 THEN o_orderkey % 7 END FROM orders),
acct_f AS (SELECT accountid, customerid, CAST(ts AS DATE) AS s, coalesce(lead(CAST(ts AS DATE)) OVER o, {_END}) AS e, last_value(status IGNORE NULLS) OVER w AS status, last_value(brokerid IGNORE NULLS) OVER w AS brokerid
  FROM acct_log WINDOW w AS (PARTITION BY accountid ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), o AS (PARTITION BY accountid ORDER BY ts, seq)),
acct AS (SELECT a.accountid, sk_customerid, a.status, brokerid, greatest(a.s, c.s) AS s, least(a.e, c.e) AS e, CAST(strftime(greatest(a.s, c.s), '%Y%m%d') || accountid AS BIGINT) AS sk_accountid
  FROM acct_f a LEFT JOIN cust c ON a.customerid = c.customerid AND a.s < c.e AND c.s < a.e WHERE a.s < a.e),
comp AS (SELECT p_partkey AS companyid, 'Company ' || p_partkey AS companyname, i, ['AAA', 'BB+', 'CC', NULL][CAST((p_partkey // 5 + i) % 4 + 1 AS INTEGER)] AS sprating, p_brand AS ceo, CASE WHEN p_partkey % 7 <> 0 THEN '1970-01-02' END AS foundingdate,
    CASE i WHEN 0 THEN DATE '1993-01-01' ELSE DATE '1998-01-01' + CAST(p_partkey % 100 AS INTEGER) END AS s, CASE i WHEN 0 THEN DATE '1998-01-01' + CAST(p_partkey % 100 AS INTEGER) ELSE {_END} END AS e
  FROM part, (VALUES (0), (1)) x(i) WHERE p_partkey % 5 = 0),
compk AS (SELECT *, CAST(strftime(s, '%Y%m%d') || companyid AS BIGINT) AS sk_companyid FROM comp),
sec AS (SELECT 'S' || p_partkey AS symbol, p_name AS name, p_partkey * 100 + CASE j WHEN 0 THEN 0 ELSE 7 END AS shares, sk_companyid, companyid, greatest(c.s, x.s) AS s, least(c.e, x.e) AS e
  FROM part, (VALUES (0, DATE '1994-06-01', DATE '1999-06-01'), (1, DATE '1999-06-01', {_END})) x(j, s, e) JOIN compk c ON c.s < x.e AND x.s < c.e WHERE companyid = p_partkey - p_partkey % 5),
fin0 AS (SELECT l_partkey - l_partkey % 5 AS firm, year(l_shipdate) AS y, quarter(l_shipdate) AS q, sum(CAST(round(l_extendedprice) AS BIGINT)) AS revenue FROM lineitem GROUP BY ALL),
fin AS (SELECT f.*, make_date(y, q * 3 - 2, 1) AS start, revenue // 4 AS earnings, revenue // 1000 AS eps, sk_companyid FROM fin0 f JOIN compk ON companyid = firm AND s <= make_date(y, q * 3 - 2, 1) + INTERVAL 3 MONTHS AND make_date(y, q * 3 - 2, 1) + INTERVAL 3 MONTHS < e),
eps AS (SELECT firm, y, q, sum(eps) OVER (PARTITION BY firm ORDER BY y, q ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS prev FROM fin),
trade AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS t_id, l_linenumber, max(o_custkey) * 10 AS accountid, 'S' || l_partkey AS symbol, max(o_orderdate) AS placed, max(greatest(l_shipdate, o_orderdate + INTERVAL 1 DAY)) AS shipped, max(l_linestatus) AS line, max(l_returnflag) AS flag,
    CAST(max(l_quantity) AS BIGINT) AS quantity, CAST(round(max(l_extendedprice) * 100) AS BIGINT) AS cents FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey),
life AS (SELECT *, CASE WHEN flag = 'R' THEN 'Canceled' WHEN line = 'F' THEN 'Completed' ELSE 'Submitted' END AS status, CASE WHEN flag = 'R' OR line = 'F' THEN shipped END AS closed FROM trade),
dtrade AS (SELECT l.*, sk_accountid, sk_customerid, sk_companyid FROM life l JOIN acct a ON a.accountid = l.accountid AND a.s <= CAST(placed AS DATE) AND CAST(placed AS DATE) < a.e JOIN sec x ON x.symbol = l.symbol AND x.s <= CAST(placed AS DATE) AND CAST(placed AS DATE) < x.e)
"""


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf: dated(f(Warehouse(spark, sf)))
        if sql:
            SQL[f.__name__] = _CTES + sql
        return f

    return register


@query("SELECT s_suppkey AS brokerid, s_name AS lastname, 'B' || s_nationkey AS branch, '1990-01-01' AS effectivedate, '9999-12-31' AS enddate, true AS iscurrent FROM supplier WHERE s_suppkey % 3 <> 0")
def wh_dim_broker(w):
    return w.dim_broker.drop("sk_brokerid")


@query("""SELECT sk_companyid, companyid, companyname, 'Active' AS status, CASE companyid % 3 WHEN 0 THEN 'Mining' WHEN 1 THEN 'Trade' ELSE 'Transport' END AS industry, sprating, CASE WHEN sprating IS NOT NULL THEN sprating <> 'AAA' END AS islowgrade, ceo, foundingdate,
CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate, i = 1 AS iscurrent FROM compk""")
def wh_dim_company(w):
    return w.dim_company


@query("SELECT symbol, 'COMMON' AS issue, 'Active' AS status, name, 'NYSE' AS exchangeid, sk_companyid, shares AS sharesoutstanding, CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate, e = DATE '9999-12-31' AS iscurrent FROM sec")
def wh_dim_security(w):
    return w.dim_security.drop("sk_securityid", "firsttrade", "dividend")


@query("SELECT sk_companyid, y AS year, q AS quarter, CAST(start AS VARCHAR) AS qtrstartdate, CAST(revenue AS BIGINT) AS revenue, CAST(earnings AS BIGINT) AS earnings, CAST(eps AS BIGINT) AS eps FROM fin")
def wh_financial(w):
    return w.financial.withColumns({c: F.col(c).cast("long") for c in ("revenue", "earnings", "eps")})


@query("SELECT firm AS companyid, y AS year, q AS quarter, CAST(prev AS BIGINT) AS prev_year_eps FROM eps")
def wh_company_year_eps(w):
    return w.company_year_eps.withColumn("prev_year_eps", F.col("prev_year_eps").cast("long"))


@query("""SELECT sk_customerid, customerid, lastname, tier, CASE WHEN upper(gender) IN ('M', 'F') THEN upper(gender) ELSE 'U' END AS gender, city, n_name AS tax_name, n_nationkey % 10 / 100 AS tax_rate, CASE action WHEN 'INACT' THEN 'Inactive' ELSE 'Active' END AS status,
CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate, e = DATE '9999-12-31' AS iscurrent FROM cust LEFT JOIN nation ON nat_tx = n_nationkey""")
def wh_dim_customer(w):
    return w.dim_customer.drop("first_city", "dob")


@query("SELECT sk_accountid, accountid, sk_customerid, brokerid, status, CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate, e = DATE '9999-12-31' AS iscurrent FROM acct")
def wh_dim_account(w):
    return w.dim_account


@query("""SELECT t_id, CAST(strftime(placed, '%Y%m%d') AS BIGINT) AS sk_createdateid, CAST(strftime(placed, '%H%M%S') AS BIGINT) AS sk_createtimeid, CAST(strftime(closed, '%Y%m%d') AS BIGINT) AS sk_closedateid, status, CASE WHEN l_linenumber % 2 = 0 THEN 'Market Buy' ELSE 'Market Sell' END AS type,
sk_accountid, sk_customerid, sk_companyid, symbol, quantity, cents FROM dtrade""")
def wh_dim_trade(w):
    return w.dim_trade.drop("sk_securityid", "commission", "fee")


@query("SELECT t_id AS hh_t_id, CASE WHEN l_linenumber % 2 = 0 THEN quantity ELSE -quantity END AS change, sk_accountid, sk_customerid, CAST(strftime(closed, '%Y%m%d') AS BIGINT) AS sk_dateid, cents AS currentprice FROM dtrade WHERE line = 'F'")
def wh_fact_holdings(w):
    return w.fact_holdings.drop("sk_securityid")


_CASH = """, day AS (SELECT o_custkey * 10 AS accountid, CAST(o_orderdate AS DATE) AS d, sum(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END * CAST(round(o_totalprice * 100) AS BIGINT)) AS total FROM orders GROUP BY ALL),
run AS (SELECT accountid, d, CAST(sum(total) OVER (PARTITION BY accountid ORDER BY d) AS BIGINT) AS cash FROM day)
SELECT r.accountid, sk_accountid, sk_customerid, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_dateid, cash FROM run r JOIN acct a ON a.accountid = r.accountid AND a.s <= d AND d < a.e"""


@query(_CASH)
def wh_fact_cash_balances(w):
    return w.fact_cash


@query(_CASH)
def wh_fact_cash_incremental(w):
    """The same fact by three increments: each starts from the balances that the one before left."""
    cash = w.feed.cash.withColumn("day", F.to_date("ct_dts"))
    edges = [F.lit(d).cast("date") for d in ("1990-01-01", "1997-01-01", "1999-06-01", "2030-01-01")]
    state, rows = cash.limit(0).select("accountid", F.col("cents").alias("balance"), "day"), None
    for lo, hi in zip(edges, edges[1:], strict=False):
        new = cash.filter((F.col("day") >= lo) & (F.col("day") < hi))
        daily = W.running_sum(W.daily_totals(new, ["accountid"], "ct_dts", "cents"), ["accountid"], ["day"], "total", "cash")
        daily = daily.join(state.select("accountid", F.col("balance").alias("_before")), "accountid", "left").withColumn("cash", F.col("cash") + F.coalesce("_before", F.lit(0))).drop("_before")
        rows = daily if rows is None else rows.unionByName(daily)
        state = tables.scratch(K.carry_forward(state, new, ["accountid"], "day", "cents").drop("touched"), "balances")
    dim = w.dim_account.select("accountid", "sk_accountid", "sk_customerid", "effectivedate", "enddate")
    return H.as_of_join(rows, dim, ["accountid"], "day").select("accountid", "sk_accountid", "sk_customerid", C.date_key("day").alias("sk_dateid"), "cash")


@query("""SELECT p.symbol, CAST(strftime(day, '%Y%m%d') AS BIGINT) AS sk_dateid, low, high, lo.v AS low_value, CAST(strftime(lo.d, '%Y%m%d') AS BIGINT) AS sk_lowdate, hi.v AS high_value, CAST(strftime(DATE '1970-01-01' - hi.b, '%Y%m%d') AS BIGINT) AS sk_highdate,
round(low / nullif(prev, 0), 6) AS peratio, round(0.25 * 100 / nullif(low, 0), 6) AS yield FROM
(SELECT *, min({'v': low, 'd': day}) OVER w AS lo, max({'v': high, 'b': CAST(DATE '1970-01-01' - day AS INTEGER)}) OVER w AS hi FROM
 (SELECT 'S' || l_partkey AS symbol, CAST(l_shipdate AS DATE) AS day, min(CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT)) AS low, max(CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT)) AS high FROM lineitem GROUP BY ALL)
 WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 364 PRECEDING AND CURRENT ROW)) p
JOIN sec x ON x.symbol = p.symbol AND x.s <= day AND day < x.e LEFT JOIN eps ON firm = companyid AND y = year(day) AND q = quarter(day)""")
def wh_fact_market_history(w):
    return w.fact_market


@query("""SELECT x.customerid, x.symbol, sk_customerid, CAST(strftime(placed, '%Y%m%d') AS BIGINT) AS sk_dateplaced, CAST(strftime(removed, '%Y%m%d') AS BIGINT) AS sk_dateremoved FROM
(SELECT user_id AS customerid, 'S' || (event_id % 20) AS symbol, CAST(min(ts) FILTER (event_type <> 'purchase') AS DATE) AS placed, CAST(max(ts) FILTER (event_type = 'purchase') AS DATE) AS removed FROM events WHERE event_type <> 'error' GROUP BY ALL) x
JOIN cust c ON c.customerid = x.customerid AND c.s <= placed AND placed < c.e JOIN sec v ON v.symbol = x.symbol AND v.s <= placed AND placed < v.e""")
def wh_fact_watches(w):
    return w.fact_watches


@query("""SELECT agencyid, first_batch, last_batch, tags AS marketingnameplate, coalesce(known, false) AS iscustomer FROM
(SELECT 'P' || c_custkey AS agencyid, c_name, c_mktsegment, (c_custkey + b) % 5 AS kids, min(b)::BIGINT AS first_batch, max(b)::BIGINT AS last_batch,
 any_value(concat_ws('+', CASE WHEN CAST(round(c_acctbal * 300) AS BIGINT) > 1000000 OR inc > 200000 THEN 'HighValue' END, CASE WHEN (c_custkey + b) % 5 > 3 OR c_custkey % 9 > 5 THEN 'Expenses' END, CASE WHEN c_custkey % 90 > 45 THEN 'Boomer' END,
 CASE WHEN inc < 50000 OR c_custkey % 850 < 600 OR CAST(round(c_acctbal * 300) AS BIGINT) < 100000 THEN 'MoneyAlert' END, CASE WHEN c_custkey % 6 > 3 OR c_custkey % 9 > 7 THEN 'Spender' END, CASE WHEN c_custkey % 90 < 25 AND CAST(round(c_acctbal * 300) AS BIGINT) > 1000000 THEN 'Inherited' END)) AS tags
 FROM (SELECT *, CASE WHEN c_custkey % 10 <> 0 THEN CAST(round(c_acctbal * 30) AS BIGINT) END AS inc FROM customer), (VALUES (1), (2), (3)) x(b) WHERE (c_custkey + b) % 4 <> 0 GROUP BY ALL) p
LEFT JOIN (SELECT DISTINCT upper(lastname) AS l, upper(first_city) AS c, true AS known FROM cust WHERE e = DATE '9999-12-31' AND action <> 'INACT') k ON l = upper(c_name) AND c = upper(c_mktsegment) WHERE last_batch = 3""")
def wh_prospect(w):
    return w.prospect.select("agencyid", "first_batch", "last_batch", "marketingnameplate", "iscustomer")


@query("""SELECT source, message, count(*) AS n FROM (SELECT 'DimCustomer' AS source, 'Invalid customer tier' AS message FROM cust WHERE NOT coalesce(tier IN (1, 2, 3), false) UNION ALL SELECT 'DimTrade', 'Large trade' FROM dtrade WHERE cents > 9000000
UNION ALL SELECT 'DimCompany', 'Invalid SPRating' FROM compk WHERE sprating IS NULL
UNION ALL SELECT 'DimCustomer', 'DOB out of range' FROM (SELECT DATE '1890-01-01' + CAST(c_custkey * 37 % 45000 AS INTEGER) AS dob FROM customer) WHERE dob <= DATE '1901-01-01' OR dob > DATE '2001-01-01'
UNION ALL SELECT 'DimTrade', unnest(CASE WHEN 12 * discount > 100 THEN ['Invalid trade commission'] ELSE [] END || CASE WHEN 13 * tax > 100 THEN ['Invalid trade fee'] ELSE [] END) FROM dtrade JOIN
  (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS t_id, CAST(max(round(l_discount * 100)) AS BIGINT) AS discount, CAST(max(round(l_tax * 100)) AS BIGINT) AS tax FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) USING (t_id)
UNION ALL SELECT 'FactMarketHistory', 'No earnings for company' FROM (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, min(CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT)) AS low FROM lineitem GROUP BY ALL) p
  JOIN sec x ON x.symbol = 'S' || l_partkey AND x.s <= day AND day < x.e LEFT JOIN eps ON firm = companyid AND y = year(day) AND q = quarter(day) WHERE low / nullif(prev, 0) IS NULL) GROUP BY ALL""")
def wh_alerts(w):
    return w.alerts.groupBy("source", "message").agg(F.count("*").alias("n"))


@query("SELECT 'OK' AS result, 43::BIGINT AS tests, 0::BIGINT AS failures FROM (SELECT count(*) FROM customer)")
def wh_audits(w):
    return w.audits().groupBy("result").agg(F.count("*").alias("tests"), F.sum("failures").alias("failures"))


@query("""SELECT sk_accountid, accountid, sk_customerid, brokerid, status, CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate, e = DATE '9999-12-31' AS iscurrent FROM acct""")
def wh_account_replay(w):
    """Accounts from a stream of change files, merged file by file in any order, then cut by their owners' versions."""
    log = w.feed.account_log
    home, cols = tables.scratch_path(w.spark, "accounts"), ["customerid", "status", "brokerid"]
    seed = K.clocked_history(log.limit(0), ["accountid"], "ts", ["seq"], cols)
    held = replay.fold(fed(log, "seq", home), seed, lambda held, batch: K.clocked_merge(held, batch, ["accountid"], "ts", ["seq"], cols), home, ["accountid"])
    dated_rows = held.drop("iscurrent", "ts", "seq", "clocks")
    both = H.overlap_join(dated_rows, w.dim_customer.select("customerid", "sk_customerid", "effectivedate", "enddate"), ["customerid"], how="left")
    return both.select(C.version_key("effectivedate", "accountid").alias("sk_accountid"), "accountid", "sk_customerid", "brokerid", C.map_codes("status", C.STATUS).alias("status"), "effectivedate", "enddate", (F.col("enddate") == H.open_end()).alias("iscurrent"))


@query("""SELECT customerid, lastname, tier, gender, city, nat_tx::BIGINT AS nat_tx, CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate, e = DATE '9999-12-31' AS iscurrent FROM cust""")
def wh_customer_incremental(w):
    """The customers' versions by a first load and two batches of sparse changes: each batch reads only its own log."""
    log, cols = C.blank_to_null(w.feed.customer_log), ["lastname", "tier", "gender", "city", "nat_tx"]
    first, rest = tables.split_at(log, "ts", F.lit("1996-06-01").cast("timestamp_ntz"))
    held = H.scd2_build(H.forward_fill(first, ["customerid"], ["ts", "seq"], cols), ["customerid"], "ts", ["seq"]).drop("action", "dob")
    for batch in tables.split_at(rest, "ts", F.lit("1999-01-01").cast("timestamp_ntz")):
        held = tables.scratch(K.scd2_merge(held, batch, ["customerid"], "ts", ["seq"], cols), "customers")
    return held.select("customerid", *cols, "effectivedate", "enddate", "iscurrent")


@query("""SELECT t_id, CAST(strftime(placed, '%Y%m%d') AS BIGINT) AS sk_createdateid, CAST(strftime(closed, '%Y%m%d') AS BIGINT) AS sk_closedateid, status, cents FROM life""")
def wh_trade_incremental(w):
    """Trades by a first load of what was known at a day, then an upsert of later status changes that only touches open trades."""
    day, log = F.lit("1998-07-01").cast("timestamp_ntz"), w.feed.trade_history
    facts = w.feed.trades.select("t_id", "cents")

    def state(rows: DataFrame) -> DataFrame:
        life = K.trade_lifecycle(rows, ["t_id"], "th_dts", "status", ["SBMT"], ["CMPT", "CNCL"])
        last = rows.groupBy("t_id").agg(F.max("th_dts").alias("th_dts"))
        opened = rows.groupBy("t_id").agg(F.max(F.when(F.col("status") == "SBMT", F.col("th_dts"))).alias("opened"))
        return life.join(last, "t_id").join(opened, "t_id").join(facts, "t_id").select("t_id", "th_dts", F.col("opened").alias("create_ts"), "close_ts", C.map_codes("status", C.STATUS).alias("status"), "cents")

    old, new = tables.split_at(log, "th_dts", day)
    held = tables.scratch(state(old), "trades")
    out = K.scd1_merge(held, state(new), ["t_id"], ["th_dts"], guard=held["close_ts"].isNull())
    return out.select("t_id", C.date_key("create_ts").alias("sk_createdateid"), C.date_key("close_ts").alias("sk_closedateid"), "status", "cents")


_WATCHES = """SELECT user_id AS customerid, 'S' || (event_id % 20) AS symbol, min(CAST(ts AS DATE)) FILTER (event_type <> 'purchase') AS placed, max(CAST(ts AS DATE)) FILTER (event_type = 'purchase') AS removed
FROM events WHERE event_type <> 'error'"""
_WATCH_CUT = "2024-01-20"


def _watches(w, rows):
    told = H.open_close(rows, ["customerid", "symbol"], "action", "ts", "CNCL")
    return told.withColumns({c: F.col(c).cast("date") for c in ("placed", "removed")})


@query(f"SELECT customerid, symbol, CAST(strftime(placed, '%Y%m%d') AS BIGINT) AS sk_dateplaced, CAST(strftime(removed, '%Y%m%d') AS BIGINT) AS sk_dateremoved FROM ({_WATCHES} GROUP BY ALL) WHERE placed IS NOT NULL")
def wh_watches_incremental(w):
    """Watches by two periods, each with its placements and cancellations, give what the whole log gives."""
    old, new = tables.split_at(w.feed.watches, "ts", F.lit(_WATCH_CUT).cast("timestamp_ntz"))
    held = tables.scratch(_watches(w, old), "watches")
    out = K.open_close_totals(held, _watches(w, new), ["customerid", "symbol"], "placed", "removed").filter("placed IS NOT NULL")
    return out.select("customerid", "symbol", C.date_key("placed").alias("sk_dateplaced"), C.date_key("removed").alias("sk_dateremoved"))


@query(f""", old AS ({_WATCHES} AND ts < TIMESTAMP '{_WATCH_CUT}' GROUP BY ALL), new AS ({_WATCHES} AND ts >= TIMESTAMP '{_WATCH_CUT}' GROUP BY ALL)
SELECT customerid, symbol, CAST(placed AS VARCHAR) AS placed, CAST(removed AS VARCHAR) AS removed FROM old WHERE placed IS NOT NULL AND removed IS NOT NULL
UNION ALL SELECT o.customerid, o.symbol, CAST(o.placed AS VARCHAR), CAST(n.removed AS VARCHAR) FROM old o LEFT JOIN new n ON n.customerid = o.customerid AND n.symbol = o.symbol AND n.placed IS NULL WHERE o.placed IS NOT NULL AND o.removed IS NULL
UNION ALL SELECT customerid, symbol, CAST(placed AS VARCHAR), CAST(removed AS VARCHAR) FROM new WHERE placed IS NOT NULL""")
def wh_watch_reopenings(w):
    """A second period's closes fill the watches that are open, and its placements are new rows, whatever the first period had."""
    old, new = tables.split_at(w.feed.watches, "ts", F.lit(_WATCH_CUT).cast("timestamp_ntz"))
    out, _ = K.open_close_merge(_watches(w, old).filter("placed IS NOT NULL"), _watches(w, new), ["customerid", "symbol"], "placed", "removed")
    return out


@query(SQL["wh_fact_watches"].removeprefix(_CTES))
def wh_watches_by_reverse_lookup(w):
    """The fact holds surrogate keys only: cancellations, told by natural keys, find their watches by way of the dimensions."""
    placed = _watches(w, w.feed.watches).filter("placed IS NOT NULL").select("customerid", "symbol", "placed")
    c = w.dim_customer.select("customerid", "sk_customerid", "effectivedate", "enddate")
    v = w.dim_security.select("symbol", "sk_securityid", "effectivedate", "enddate")
    fact = H.as_of_join(placed, c, ["customerid"], "placed").drop("effectivedate", "enddate")
    fact = tables.scratch(H.as_of_join(fact, v, ["symbol"], "placed").select("sk_customerid", "sk_securityid", "placed"), "fact")
    named = fact.join(w.dim_customer.select("sk_customerid", "customerid"), "sk_customerid").join(w.dim_security.select("sk_securityid", "symbol"), "sk_securityid")
    gone = w.feed.watches.filter("action = 'CNCL'").groupBy("customerid", "symbol").agg(F.max(F.to_date("ts")).alias("removed"))
    return named.join(gone, ["customerid", "symbol"], "left").select("customerid", "symbol", "sk_customerid", C.date_key("placed").alias("sk_dateplaced"), C.date_key("removed").alias("sk_dateremoved"))


@query(SQL["wh_fact_holdings"].removeprefix(_CTES))
def wh_holdings_incremental(w):
    """Holdings by two periods: each joins only the trades that were closed in it (the close date prunes the trades)."""
    path = tables.scratch_path(w.spark, "trades")
    t = w.dim_trade.select(F.col("t_id").alias("hh_t_id"), "sk_accountid", "sk_customerid", "sk_closedateid", "cents").withColumn("closed_in", F.coalesce(F.expr("sk_closedateid div 10000"), F.lit(0)))
    tables.overwrite(t.hint("rebalance", "closed_in"), path, ["closed_in"])
    trades = w.spark.read.parquet(path)
    at = w.feed.trades.select(F.col("t_id").alias("hh_t_id"), F.year("shipped").alias("at"))
    periods = []
    for lo, hi in ((0, 1997), (1997, 10_000)):
        own = [w.feed.holdings, at.filter((F.col("at") >= lo) & (F.col("at") < hi)), trades.filter((F.col("closed_in") >= lo) & (F.col("closed_in") < hi))]
        told = lambda held, at, t: held.join(at, "hh_t_id").join(t, "hh_t_id").select("hh_t_id", "change", "sk_accountid", "sk_customerid", F.col("sk_closedateid").alias("sk_dateid"), F.col("cents").alias("currentprice"))
        periods.append(tables.by_slices(told, own, ["hh_t_id"], "fact"))
    return periods[0].unionByName(periods[1])


@query(SQL["wh_fact_market_history"].removeprefix(_CTES))
def wh_market_incremental(w):
    """Prices by two periods: the second one's frames are made of its own rows and the last 364 of each symbol before it, which are picked out of the whole history (``wh_market_daily`` reads a year only)."""
    cut = F.lit("1998-01-01").cast("date")

    def told(days: DataFrame) -> DataFrame:
        old, new = tables.split_at(days, "day", cut)
        first = W.rolling_extremes(old, ["symbol"], "day", "low", "high")
        tail = W.top_rows(old, ["symbol"], [F.desc("day")], 364)
        second = W.rolling_extremes(tail.unionByName(new), ["symbol"], "day", "low", "high").filter(F.col("day") >= cut)
        return w.market_told(first.unionByName(second))

    return tables.by_slices(told, [w.feed.market], ["symbol"], "fact")


@query("SELECT sk_accountid, accountid, sk_customerid, brokerid, status, CAST(s AS VARCHAR) AS effectivedate, CAST(e AS VARCHAR) AS enddate, e = DATE '9999-12-31' AS iscurrent FROM acct")
def wh_account_incremental(w):
    """Accounts by two periods: a second period's changes of accounts and of their owners work only on the accounts that either touches."""
    cut, cols = F.lit("1997-01-01").cast("timestamp_ntz"), ["customerid", "status", "brokerid"]
    a_old, a_new = tables.split_at(w.feed.account_log, "ts", cut)
    c_new = w.feed.customer_log.filter(F.col("ts") >= cut)
    owners = w.dim_customer.select("customerid", "sk_customerid", "effectivedate", "enddate")
    before = owners.filter(F.col("effectivedate") < cut.cast("date")).withColumn("enddate", F.when(F.col("enddate") < cut.cast("date"), F.col("enddate")).otherwise(H.open_end()))

    def laid(versions: DataFrame, held: DataFrame) -> DataFrame:
        both = H.overlap_join(versions.drop("iscurrent", "ts", "seq"), held, ["customerid"], how="left")
        return both.select(C.version_key("effectivedate", "accountid").alias("sk_accountid"), "accountid", "sk_customerid", "brokerid", C.map_codes("status", C.STATUS).alias("status"), "effectivedate", "enddate", (F.col("enddate") == H.open_end()).alias("iscurrent"))

    base = tables.scratch(H.scd2_build(H.forward_fill(a_old, ["accountid"], ["ts", "seq"], cols), ["accountid"], "ts", ["seq"]), "accounts")
    dim = tables.scratch(laid(base, before), "dim_account")
    merged = tables.scratch(K.scd2_merge(base, a_new, ["accountid"], "ts", ["seq"], cols), "accounts")
    touched = a_new.select("accountid").union(merged.join(c_new.select("customerid"), "customerid", "left_semi").select("accountid")).distinct()
    again = laid(merged.join(touched, "accountid", "left_semi"), owners)
    return dim.join(touched, "accountid", "left_anti").unionByName(again.select(*dim.columns))


@query(SQL["wh_dim_customer"].removeprefix(_CTES))
def wh_customer_from_files(w):
    """History and later changes from batch files of two shapes (the later ones with change columns), read as one table in one pass."""
    root, log = tables.scratch_path(w.spark, "batches"), w.feed.customer_log
    edges = [F.lit(d).cast("timestamp_ntz") for d in ("1990-01-01", "1996-01-01", "1998-01-01", "2030-01-01")]
    for b, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False), 1):
        own = log.filter((F.col("ts") >= lo) & (F.col("ts") < hi))
        own = own if b == 1 else own.select(F.lit("U").alias("cdc_flag"), F.col("seq").alias("cdc_dsn"), "*")
        own.write.parquet(f"{root}/Batch{b}")
    spec = files.TableSpec("customer", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in log.schema), "*.parquet", batches=(1, 2, 3), cdc_from=2)
    return w.customers_told(files.read_table(w.spark, spec, root, "parquet").drop("batchid")).drop("first_city", "dob")


@query("""SELECT n::BIGINT AS batchid, 'P' || c_custkey AS agencyid, min(b)::BIGINT AS first_batch, max(b)::BIGINT AS last_batch FROM (SELECT *, (c_custkey + b) % 5 AS kids FROM customer, (VALUES (1), (2), (3)) x(b) WHERE (c_custkey + b) % 4 <> 0), (VALUES (1), (2), (3)) y(n)
WHERE b <= n GROUP BY n, c_custkey, kids HAVING max(b) = n""")
def wh_prospect_batches(w):
    """The prospects that each batch knows, told from one table of distinct rows."""
    p = w.feed.prospects
    diff = tables.scratch(H.snapshot_diff(p, [c for c in p.columns if c != "batchid"]), "prospects")
    each = [H.as_of_batch(diff, n).select(F.lit(n).cast("long").alias("batchid"), "agencyid", "first_batch", "last_batch") for n in (1, 2, 3)]
    return each[0].union(each[1]).union(each[2])


@query("""SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_dateid, CAST(d AS VARCHAR) AS datevalue, year(d) AS calendaryear, quarter(d) AS calendarqtr, month(d) AS calendarmonth, week(d) AS calendarweek, dayofweek(d) + 1 AS dayofweek, dayofweek(d) IN (0, 6) AS weekend
FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
def wh_dim_date(w):
    return w.trading_days


@query("""SELECT s AS st_id, CASE s WHEN 'SBMT' THEN 'Submitted' WHEN 'CMPT' THEN 'Completed' ELSE 'Canceled' END AS st_name FROM (SELECT 'SBMT' AS s FROM trade UNION SELECT CASE WHEN flag = 'R' THEN 'CNCL' ELSE 'CMPT' END FROM trade WHERE flag = 'R' OR line = 'F')""")
def wh_status_type(w):
    return w.status_type


@query("SELECT DISTINCT CASE WHEN l_linenumber % 2 = 0 THEN 'TMB' ELSE 'TMS' END AS tt_id, CASE WHEN l_linenumber % 2 = 0 THEN 'Market Buy' ELSE 'Market Sell' END AS tt_name, l_linenumber % 2 AS tt_is_sell FROM trade")
def wh_trade_type(w):
    return w.trade_type


@query("SELECT year(o_orderdate) AS batchid, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS batchdate FROM orders GROUP BY 1")
def wh_batch_date(w):
    return w.batch_date


@query("""SELECT c_nationkey::BIGINT AS c_nationkey, count(*) AS customers, count(*) AS places, 0 AS lowest, count(*) - 1 AS highest FROM customer GROUP BY 1""")
def wh_pool_permutation(w):
    """Each nation's customers are dealt new places within their own nation: as many places as customers, from 0 on."""
    from ledgerloom.operators.pools import permuted

    c = W.dense_index(w.feed.read("customer").select("c_nationkey", "c_custkey"), ["c_nationkey", "c_custkey"], "nth")
    sizes = c.groupBy("c_nationkey").agg(F.count("*").alias("size"), F.min("nth").alias("first"))
    dealt = c.join(sizes, "c_nationkey").withColumn("place", permuted(F.col("nth") - F.col("first"), "size", F.col("c_nationkey").cast("long")))
    return dealt.groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.count_distinct("place").alias("places"), F.min("place").alias("lowest"), F.max("place").alias("highest"))


def _hot(w: Warehouse) -> Warehouse:
    return Warehouse(w.spark, w.dir, hot_keys=True)


@query(SQL["wh_dim_customer"].removeprefix(_CTES))
def wh_dim_customer_by_blocks(w):
    """The same table with every customer's actions dealt over tasks by year."""
    return _hot(w).dim_customer.drop("first_city", "dob")


@query(SQL["wh_dim_account"].removeprefix(_CTES))
def wh_dim_account_by_blocks(w):
    """The same table with every account's actions dealt by year, and accounts and owners meeting in buckets of days."""
    return _hot(w).dim_account


@query(_CASH)
def wh_fact_cash_by_blocks(w):
    """The same fact with every account's days dealt by year."""
    return _hot(w).fact_cash
