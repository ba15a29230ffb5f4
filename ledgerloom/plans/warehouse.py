"""The warehouse tables, each a function of feeds and of tables built before it."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import clean as C
from ledgerloom.operators import audit as A
from ledgerloom.operators import changes as K
from ledgerloom.operators import history as H
from ledgerloom.operators import matching as M
from ledgerloom.operators import windows as W
from ledgerloom.plans import feeds as fd
from ledgerloom.sources import files, tables


class Warehouse:
    """Batch load; a table that others read is written once and read back.

    With ``hot_keys`` histories and balances are computed in blocks of a year, for feeds in which
    one customer or account may hold a great part of all rows; the feeds are then read more often.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, hot_keys: bool = False):
        self.spark, self.dir, self.feed, self.hot_keys = spark, sf_dir, fd.Feeds(spark, sf_dir), hot_keys

    def _versions(self, log: DataFrame, key: str, cols: list[str]) -> DataFrame:
        """A history from a sparse log of (key, ts, seq)."""
        if not self.hot_keys:
            return H.scd2_build(H.forward_fill(log, [key], ["ts", "seq"], cols), [key], "ts", ["seq"])
        filled = self._kept(H.forward_fill_blocks(log, [key], ["ts", "seq"], cols, F.year("ts")), "filled")
        return H.scd2_build(filled, [key], "ts", ["seq"], block=F.year("ts"))

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return tables.scratch(df, name)

    # ---- reference tables

    @cached_property
    def dim_date(self) -> DataFrame:
        days = self.spark.sql("SELECT explode(sequence(DATE'1990-01-01', DATE'2029-12-31')) AS datevalue")
        d = F.col("datevalue")
        return days.select(C.date_key(d).alias("sk_dateid"), "datevalue", F.year(d).alias("calendaryear"), F.quarter(d).alias("calendarqtr"), F.month(d).alias("calendarmonth"), F.weekofyear(d).alias("calendarweek"), F.dayofweek(d).alias("dayofweek"), (F.dayofweek(d).isin(1, 7)).alias("weekend"))

    @cached_property
    def trading_days(self) -> DataFrame:
        """``dim_date`` for the days from the first to the last order."""
        o = self.feed.read("orders").agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))  # one row
        return self.dim_date.join(F.broadcast(o), F.col("datevalue").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")

    @cached_property
    def status_type(self) -> DataFrame:
        """Codes that trades' logs use, with their names."""
        s = self.feed.trade_history.select(F.col("status").alias("st_id")).distinct()
        return s.select("st_id", C.map_codes("st_id", C.STATUS).alias("st_name"))

    @cached_property
    def trade_type(self) -> DataFrame:
        s = self.feed.trades.select(F.col("type").alias("tt_id")).distinct()
        return s.select("tt_id", C.map_codes("tt_id", C.TRADE_TYPE).alias("tt_name"), F.when(F.col("tt_id").like("%S"), 1).otherwise(0).alias("tt_is_sell"))

    @cached_property
    def batch_date(self) -> DataFrame:
        """The last day that each yearly batch of orders knows."""
        return self.feed.read("orders").groupBy(F.year("o_orderdate").alias("batchid")).agg(F.max(F.to_date("o_orderdate")).alias("batchdate"))

    @cached_property
    def dim_time(self) -> DataFrame:
        s = self.spark.range(86_400).withColumn("t", F.timestamp_seconds("id"))
        h = F.hour("t")
        return s.select(C.time_key("t").alias("sk_timeid"), F.date_format("t", "HH:mm:ss").alias("timevalue"), h.alias("hourid"), F.minute("t").alias("minuteid"), F.second("t").alias("secondid"), h.between(9, 15).alias("markethoursflag"), h.between(8, 17).alias("officehoursflag"))

    @cached_property
    def tax_rate(self) -> DataFrame:
        n = self.feed.read("nation")
        return n.select(F.col("n_nationkey").cast("long").alias("tx_id"), F.col("n_name").alias("tx_name"), (F.col("n_nationkey") % 10 / 100).alias("tx_rate"))

    @cached_property
    def industry(self) -> DataFrame:
        return self.spark.sql("SELECT * FROM VALUES ('I0', 'Mining'), ('I1', 'Trade'), ('I2', 'Transport') AS t(in_id, in_name)")

    # ---- dimensions

    @cached_property
    def dim_broker(self) -> DataFrame:
        first = self.dim_date.agg(F.min("datevalue").alias("effectivedate"))  # one row
        b = self.feed.hr.filter("jobcode = '314'").select(F.col("employeeid").alias("sk_brokerid"), F.col("employeeid").alias("brokerid"), "lastname", "branch")
        return b.crossJoin(F.broadcast(first)).withColumns({"enddate": H.open_end(), "iscurrent": F.lit(True)})

    @cached_property
    def company_records(self) -> DataFrame:
        return self.feed.finwire("CMP").filter("rectype = 'CMP'")

    @cached_property
    def dim_company(self) -> DataFrame:
        rows = files.parse_fixed_width(self.company_records, fd.CMP, keep=["pts"])
        rows = rows.withColumns({"cik": F.col("cik").cast("long"), "sprating": C.valid_rating("sprating"), "islowgrade": C.low_grade("sprating")})
        dated = H.scd2_build(rows, ["cik"], "pts")
        named = M.lookup(dated, self.industry, "industryid", "in_id", {"in_name": "industry"})
        out = named.select(C.version_key("effectivedate", "cik").alias("sk_companyid"), F.col("cik").alias("companyid"), "companyname", C.map_codes("status", C.STATUS).alias("status"), "industry", "sprating", "islowgrade", "ceo", "foundingdate", "effectivedate", "enddate", "iscurrent")
        return self._kept(out, "dim_company")

    def _company_keys(self) -> DataFrame:
        return M.exploded_keys(self.dim_company.select("sk_companyid", "companyid", "companyname", "effectivedate", "enddate"), ["companyname", "companyid"]).select("alt_key", "sk_companyid", "effectivedate", "enddate")

    @cached_property
    def dim_security(self) -> DataFrame:
        rows = files.parse_fixed_width(self.feed.finwire("SEC").filter("rectype = 'SEC'"), fd.SEC, keep=["pts"])
        dated = H.scd2_build(rows.withColumn("alt_key", C.id_or_name("conameorcik")), ["symbol"], "pts")
        both = H.overlap_join(dated.drop("iscurrent"), self._company_keys(), ["alt_key"])
        out = both.select(F.xxhash64("symbol", "effectivedate").alias("sk_securityid"), "symbol", F.col("issue"), C.map_codes("status", C.STATUS).alias("status"), "name", "exchangeid", "sk_companyid", "sharesoutstanding", "firsttrade", "dividend", "effectivedate", "enddate", (F.col("enddate") == H.open_end()).alias("iscurrent"))
        return self._kept(out, "dim_security")

    @cached_property
    def financial(self) -> DataFrame:
        rows = files.parse_fixed_width(self.feed.finwire("FIN").filter("rectype LIKE 'FIN%'"), fd.FIN, keep=["pts"])
        rows = rows.withColumn("alt_key", C.id_or_name("conameorcik"))
        joined = H.as_of_join(rows, self._company_keys(), ["alt_key"], "pts")
        return self._kept(joined.select("sk_companyid", "year", "quarter", "qtrstartdate", "revenue", "earnings", "eps"), "financial")

    @cached_property
    def company_year_eps(self) -> DataFrame:
        """Earnings per share of each company's four quarters before a quarter."""
        own = self.financial.join(self.dim_company.select("sk_companyid", "companyid"), "sk_companyid")
        return self._kept(W.trailing_sum(own, ["companyid"], ["year", "quarter"], "eps", 4, out="prev_year_eps").select("companyid", "year", "quarter", "prev_year_eps"), "company_year_eps")

    @cached_property
    def prospect(self) -> DataFrame:
        p = self.feed.prospects.withColumn("marketingnameplate", C.marketing_tags())
        diff = H.snapshot_diff(p, [c for c in p.columns if c != "batchid"])
        people = self.dim_customer.filter("iscurrent AND status = 'Active'").select("lastname", F.col("first_city").alias("city"))
        return M.identity_match(H.as_of_batch(diff, 3), people, ["lastname", "city"], flag="iscustomer")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._kept(self.customers_told(self.feed.customer_log), "dim_customer")

    def customers_told(self, log: DataFrame) -> DataFrame:
        """Versions from a log of actions."""
        log = C.blank_to_null(log).withColumn("status", C.map_codes("action", C.ACTION_STATUS)).withColumn("first_city", F.when(F.col("action") == "NEW", F.col("city")))
        dated = self._versions(log, "customerid", ["lastname", "tier", "gender", "city", "first_city", "nat_tx", "dob"])
        taxed = M.lookup(dated, self.tax_rate, "nat_tx", "tx_id", {"tx_name": "tax_name", "tx_rate": "tax_rate"})
        return taxed.select(C.version_key("effectivedate", "customerid").alias("sk_customerid"), "customerid", "lastname", "tier", C.gender("gender").alias("gender"), "dob", "city", "first_city", "tax_name", "tax_rate", "status", "effectivedate", "enddate", "iscurrent")

    @cached_property
    def dim_account(self) -> DataFrame:
        dated = self._versions(self.feed.account_log, "accountid", ["status", "brokerid"]).drop("iscurrent", "ts", "seq")
        owners = self.dim_customer.select("customerid", "sk_customerid", "effectivedate", "enddate")
        if self.hot_keys:
            dated = self._kept(dated, "dated")
        both = H.overlap_join(dated, owners, ["customerid"], how="left", bucket_days=3653 if self.hot_keys else None)
        out = both.select(C.version_key("effectivedate", "accountid").alias("sk_accountid"), "accountid", "sk_customerid", "brokerid", C.map_codes("status", C.STATUS).alias("status"), "effectivedate", "enddate", (F.col("enddate") == H.open_end()).alias("iscurrent"))
        return self._kept(out, "dim_account")

    @cached_property
    def dim_trade(self) -> DataFrame:
        return tables.by_slices(self.trades_told, [self.feed.trades, self.feed.trade_history], ["t_id"], "dim_trade")

    def trades_told(self, trades: DataFrame, history: DataFrame) -> DataFrame:
        """Trades with their life cycles from a log of their status, and with the accounts and securities of their time."""
        life = K.trade_lifecycle(history, ["t_id"], "th_dts", "status", ["SBMT"], ["CMPT", "CNCL"])
        rows = trades.join(life, "t_id")
        rows = H.as_of_join(rows, self.dim_account.select("accountid", "sk_accountid", "sk_customerid", "effectivedate", "enddate"), ["accountid"], "create_ts").drop("effectivedate", "enddate")
        rows = H.as_of_join(rows, self.dim_security.select("symbol", "sk_securityid", "sk_companyid", "effectivedate", "enddate"), ["symbol"], "create_ts").drop("effectivedate", "enddate")
        return rows.select("t_id", C.date_key("create_ts").alias("sk_createdateid"), C.time_key("create_ts").alias("sk_createtimeid"), C.date_key("close_ts").alias("sk_closedateid"), C.map_codes("status", C.STATUS).alias("status"), C.map_codes("type", C.TRADE_TYPE).alias("type"),
                          "sk_accountid", "sk_customerid", "sk_securityid", "sk_companyid", "symbol", "quantity", "cents", "commission", "fee")

    # ---- facts

    @cached_property
    def fact_holdings(self) -> DataFrame:
        t = self.dim_trade.select(F.col("t_id").alias("hh_t_id"), "sk_accountid", "sk_customerid", "sk_securityid", "sk_closedateid", "cents")
        told = lambda held, t: held.join(t, "hh_t_id").select("hh_t_id", "change", "sk_accountid", "sk_customerid", "sk_securityid", F.col("sk_closedateid").alias("sk_dateid"), F.col("cents").alias("currentprice"))
        return tables.by_slices(told, [self.feed.holdings, t], ["hh_t_id"], "fact_holdings")

    @cached_property
    def fact_cash(self) -> DataFrame:
        totals = W.daily_totals(self.feed.cash, ["accountid"], "ct_dts", "cents")
        by_day = (["accountid"], ["day"], "total")
        daily = W.running_sum_blocks(totals, *by_day, F.year("day"), "cash") if self.hot_keys else W.running_sum(totals, *by_day, "cash")
        rows = H.as_of_join(daily, self.dim_account.select("accountid", "sk_accountid", "sk_customerid", "effectivedate", "enddate"), ["accountid"], "day")
        return self._kept(rows.select("accountid", "sk_accountid", "sk_customerid", C.date_key("day").alias("sk_dateid"), "cash"), "fact_cash")

    @cached_property
    def fact_market(self) -> DataFrame:
        told = lambda days: self.market_told(W.rolling_extremes(days, ["symbol"], "day", "low", "high"))
        return tables.by_slices(told, [self.feed.market], ["symbol"], "fact_market")

    @cached_property
    def security_companies(self) -> DataFrame:
        """Securities' versions with the number of their company, by which earnings are told."""
        both = self.dim_security.join(self.dim_company.select("sk_companyid", "companyid"), "sk_companyid")
        return self._kept(both.select("symbol", "sk_securityid", "sk_companyid", "companyid", "dividend", "effectivedate", "enddate"), "security_companies")

    def market_told(self, w: DataFrame) -> DataFrame:
        """Days with their extremes, joined by the security and the earnings of their time."""
        s = H.as_of_join(w, self.security_companies.select("symbol", "companyid", "dividend", "effectivedate", "enddate"), ["symbol"], "day").drop("effectivedate", "enddate")
        s = s.withColumns({"year": F.year("day"), "quarter": F.quarter("day")})
        s = s.join(self.company_year_eps, ["companyid", "year", "quarter"], "left")
        sixth = lambda x: F.round(x * 1e6) / 1e6  # noqa: E731  as DuckDB rounds doubles: ``round(x, 6)`` would round their decimal text
        return s.select("symbol", C.date_key("day").alias("sk_dateid"), "low", "high", "low_value", C.date_key("low_day").alias("sk_lowdate"), "high_value", C.date_key("high_day").alias("sk_highdate"), sixth(C.safe_ratio("low", "prev_year_eps")).alias("peratio"), sixth(C.safe_ratio(F.col("dividend") * 100, "low")).alias("yield"))

    @cached_property
    def fact_watches(self) -> DataFrame:
        w = H.open_close(self.feed.watches, ["customerid", "symbol"], "action", "ts", "CNCL").filter("placed IS NOT NULL")
        w = w.withColumns({c: F.col(c).cast("date") for c in ("placed", "removed")})
        w = H.as_of_join(w, self.dim_customer.select("customerid", "sk_customerid", "effectivedate", "enddate"), ["customerid"], "placed").drop("effectivedate", "enddate")
        w = H.as_of_join(w, self.dim_security.select("symbol", "sk_securityid", "effectivedate", "enddate"), ["symbol"], "placed").drop("effectivedate", "enddate")
        return w.select("customerid", "symbol", "sk_customerid", C.date_key("placed").alias("sk_dateplaced"), C.date_key("removed").alias("sk_dateremoved"))

    # ---- validation

    @property
    def batch_day(self) -> Column:
        """The day of the batch, by which birth dates are judged."""
        return F.lit("2001-01-01").cast("date")

    @cached_property
    def alerts(self) -> DataFrame:
        tell = lambda label, c: F.concat(F.lit(label), F.col(c).cast("string"))
        cmp = files.parse_fixed_width(self.company_records, fd.CMP, keep=["pts"])
        return A.alerts([
            ("DimCustomer", "Invalid customer tier", self.dim_customer, ~F.coalesce(F.col("tier").isin(1, 2, 3), F.lit(False)), tell("C_ID = ", "customerid")),
            ("DimCustomer", "DOB out of range", self.dim_customer.select("customerid", "dob").distinct(), (F.col("dob") <= F.add_months(self.batch_day, -1200)) | (F.col("dob") > self.batch_day), F.concat(tell("C_ID = ", "customerid"), tell(", C_DOB = ", "dob"))),
            # commission and fee are told in hundredths of cents
            ("DimTrade", "Invalid trade commission", self.dim_trade, F.col("commission") > 100 * F.col("cents"), F.concat(tell("T_ID = ", "t_id"), tell(", T_COMM = ", "commission"))),
            ("DimTrade", "Invalid trade fee", self.dim_trade, F.col("fee") > 100 * F.col("cents"), F.concat(tell("T_ID = ", "t_id"), tell(", T_CHRG = ", "fee"))),
            ("DimTrade", "Large trade", self.dim_trade, F.col("cents") > 9_000_000, tell("T_ID = ", "t_id")),
            ("FactMarketHistory", "No earnings for company", self.fact_market, F.col("peratio").isNull(), tell("SYMBOL = ", "symbol")),
            ("DimCompany", "Invalid SPRating", cmp, ~F.coalesce(F.col("sprating").isin(*C.RATINGS), F.lit(False)), tell("CO_ID = ", "cik")),
        ])

    def audits(self) -> DataFrame:
        """All checks over the loaded tables."""
        dims = [("DimCustomer", self.dim_customer, "customerid", "sk_customerid"), ("DimAccount", self.dim_account, "accountid", "sk_accountid"), ("DimCompany", self.dim_company, "companyid", "sk_companyid"), ("DimSecurity", self.dim_security, "symbol", "sk_securityid")]
        out = [A.check_scd2(n, d, [k]) for n, d, k, _ in dims] + [A.check_unique(f"{n} distinct keys", d, [sk]) for n, d, _, sk in dims]
        t, customers, f = self.dim_trade, self.dim_customer, F.col
        out += [
            A.check_reference("DimAccount customer", self.dim_account, "sk_customerid", customers, "sk_customerid"),
            A.check_contained("DimAccount within customer", self.dim_account, "sk_customerid", "effectivedate", "enddate", customers, "sk_customerid"),
            A.check_contained("DimSecurity within company", self.dim_security, "sk_companyid", "effectivedate", "enddate", self.dim_company, "sk_companyid"),
            A.check_reference("DimTrade account", t, "sk_accountid", self.dim_account, "sk_accountid"),
            A.check_reference("DimTrade security", t, "sk_securityid", self.dim_security, "sk_securityid"),
            A.check_reference("FactHoldings account", self.fact_holdings, "sk_accountid", self.dim_account, "sk_accountid"),
            A.check_domain("DimCustomer status", customers, "status", ["Active", "Inactive"]),
            A.check_domain("DimCustomer gender", customers, "gender", ["M", "F", "U"]),
            A.check_domain("DimTrade status", t, "status", [*C.STATUS.values()]),
            A.check_domain("DimTrade type", t, "type", [*C.TRADE_TYPE.values()]),
            A.check_domain("DimCompany rating", self.dim_company.filter("sprating IS NOT NULL"), "sprating", C.RATINGS),
            A.check_domain("Financial quarter", self.financial, "quarter", [1, 2, 3, 4]),
            A.check("Financial quarter start", self.financial, f("qtrstartdate") != F.make_date("year", f("quarter") * 3 - 2, F.lit(1))),
            A.check("DimTrade dates", t, f("sk_closedateid") < f("sk_createdateid")),
            A.check("FactMarketHistory prices", self.fact_market, (f("low") > f("high")) | (f("low_value") > f("low")) | (f("high_value") < f("high"))),
            A.check("FactWatches dates", self.fact_watches, f("sk_dateremoved") < 0),
            A.check_count("DimTrade complete", t.agg(F.count("*").alias("n")).withColumn("k", F.lit(1)), self.feed.trades.agg(F.count("*").alias("n")).withColumn("k", F.lit(1)), ["k"], "n"),
            A.check_count("FactCash complete", self.fact_cash.agg(F.count("*").alias("n")).withColumn("k", F.lit(1)), W.daily_totals(self.feed.cash, ["accountid"], "ct_dts", "cents").agg(F.count("*").alias("n")).withColumn("k", F.lit(1)), ["k"], "n"),
            A.check("DimCustomer tax", customers.join(self.tax_rate, f("tax_name") == f("tx_name"), "left"), ~f("tax_rate").eqNullSafe(f("tx_rate"))),
        ]
        return A.one_by_one(out, "audits")
