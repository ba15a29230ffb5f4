"""Brokerage feeds derived from the given tables by Spark: change logs, fixed-width records, trades, prices.

They take the place of a data generator, so that their size grows with the input. Each
feed is an expression of the tables' rows; nothing is drawn at random.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.audit import union
from ledgerloom.sources import files, tables

#: Layouts of the fixed-width records after the date and type: (name, start, length, type).
CMP = [
    ("companyname", 1, 60, "string"), ("cik", 61, 10, "string"), ("status", 71, 4, "string"), ("industryid", 75, 2, "string"), ("sprating", 77, 4, "string"), ("foundingdate", 81, 8, "date"),
    ("addrline1", 89, 80, "string"), ("addrline2", 169, 80, "string"), ("postalcode", 249, 12, "string"), ("city", 261, 25, "string"), ("stateprov", 286, 20, "string"), ("country", 306, 24, "string"), ("ceo", 330, 46, "string"), ("description", 376, 150, "string"),
]
SEC = [
    ("symbol", 1, 15, "string"), ("issue", 16, 6, "string"), ("status", 22, 4, "string"), ("name", 26, 70, "string"), ("exchangeid", 96, 6, "string"), ("sharesoutstanding", 102, 13, "long"),
    ("firsttrade", 115, 8, "date"), ("firsttradeonexchange", 123, 8, "date"), ("dividend", 131, 12, "double"), ("conameorcik", 143, 60, "string"),
]
FIN = [
    ("year", 1, 4, "int"), ("quarter", 5, 1, "int"), ("qtrstartdate", 6, 8, "date"), ("postingdate", 14, 8, "date"), ("revenue", 22, 17, "double"), ("earnings", 39, 17, "double"), ("eps", 56, 12, "double"), ("dilutedeps", 68, 12, "double"), ("margin", 80, 12, "double"),
    ("inventory", 92, 17, "double"), ("assets", 109, 17, "double"), ("liability", 126, 17, "double"), ("sharesout", 143, 13, "long"), ("dilutedsharesout", 156, 13, "long"), ("conameorcik", 169, 60, "string"),
]


class Feeds:
    """One property per feed; ``feed.name`` reads from the tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    @property
    def hr(self) -> DataFrame:
        s = self.read("supplier")
        return s.select(F.col("s_suppkey").alias("employeeid"), F.col("s_name").alias("lastname"), F.when(F.col("s_suppkey") % 3 != 0, "314").otherwise("999").alias("jobcode"), F.concat(F.lit("B"), F.col("s_nationkey").cast("string")).alias("branch"))

    @property
    def customer_log(self) -> DataFrame:
        """Sparse actions: a NEW one for each customer, then updates that tell some columns."""
        c, o, k = self.read("customer"), self.read("orders"), F.col("o_orderkey")
        new = c.select(
            F.col("c_custkey").alias("customerid"), F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int")).cast("timestamp_ntz").alias("ts"), F.lit(-1).cast("long").alias("seq"), F.lit("NEW").alias("action"), F.col("c_name").alias("lastname"),
            (F.col("c_custkey") % 3 + 1).alias("tier"), F.when(F.col("c_custkey") % 3 == 0, "m").when(F.col("c_custkey") % 3 == 1, "F").otherwise("x").alias("gender"), F.col("c_mktsegment").alias("city"), F.col("c_nationkey").cast("long").alias("nat_tx"), F.date_add(F.lit("1890-01-01").cast("date"), (F.col("c_custkey") * 37 % 45_000).cast("int")).alias("dob"),
        )
        null = F.lit(None)
        upd = o.select(
            F.col("o_custkey").alias("customerid"), F.col("o_orderdate").alias("ts"), k.alias("seq"), F.when(k % 50 == 9, "INACT").otherwise("UPDCUST").alias("action"), null.cast("string").alias("lastname"),
            F.when(k % 2 == 0, k % 5).alias("tier"), null.cast("string").alias("gender"), F.when(k % 4 == 0, F.col("o_orderpriority")).otherwise("").alias("city"), null.cast("long").alias("nat_tx"), null.cast("date").alias("dob"),
        )
        return new.unionByName(upd)

    @property
    def account_log(self) -> DataFrame:
        c, o, k = self.read("customer"), self.read("orders"), F.col("o_orderkey")
        new = c.select((F.col("c_custkey") * 10).alias("accountid"), F.col("c_custkey").alias("customerid"), F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int")).cast("timestamp_ntz").alias("ts"), F.lit(-1).cast("long").alias("seq"), F.lit("ACTV").alias("status"), (F.col("c_custkey") % 7).alias("brokerid"))
        upd = o.select((F.col("o_custkey") * 10).alias("accountid"), F.col("o_custkey").alias("customerid"), F.col("o_orderdate").alias("ts"), k.alias("seq"), F.when(k % 40 == 1, "INAC").alias("status"), F.when(k % 8 == 1, k % 7).alias("brokerid"))
        return new.unionByName(upd)

    @cached_property
    def trades(self) -> DataFrame:
        """Several feeds are told from the trades, so they are written once."""
        both = self.read("lineitem").join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        # the tables repeat some (order, line) pairs: a trade is such a pair with its part and supplier
        rows = both.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(
            F.max("o_custkey").alias("cust"), F.max("o_orderdate").alias("placed"), F.max(F.greatest("l_shipdate", F.col("o_orderdate") + F.expr("interval 1 day"))).alias("shipped"), F.max("l_linestatus").alias("line"), F.max("l_returnflag").alias("flag"), F.max("l_quantity").alias("quantity"), F.max("l_extendedprice").alias("price"),
            F.max(F.round(F.col("l_discount") * 100).cast("long")).alias("discount"), F.max(F.round(F.col("l_tax") * 100).cast("long")).alias("tax"),
        ).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("t_id"), (F.col("cust") * 10).alias("accountid"), F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("symbol"), "placed", "shipped", "line", "flag",
            F.col("quantity").cast("long").alias("quantity"), F.round(F.col("price") * 100).cast("long").alias("cents"), F.when(F.col("l_linenumber") % 2 == 0, "TMB").otherwise("TMS").alias("type"),
            # some commissions and fees are above what was traded
            (F.round(F.col("price") * 100).cast("long") * F.col("discount") * 12).alias("commission"), (F.round(F.col("price") * 100).cast("long") * F.col("tax") * 13).alias("fee"),
        )
        return tables.scratch(rows, "trades")

    @property
    def trade_history(self) -> DataFrame:
        told = lambda ts, code: F.struct(F.col(ts).alias("th_dts"), F.lit(code).alias("status"))
        line = F.when(F.col("flag") == "R", told("shipped", "CNCL")).when(F.col("line") == "F", told("shipped", "CMPT"))
        return self.trades.select("t_id", F.inline(F.array_compact(F.array(told("placed", "SBMT"), line))))

    @property
    def cash(self) -> DataFrame:
        sign = F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1)
        return self.read("orders").select((F.col("o_custkey") * 10).alias("accountid"), F.col("o_orderdate").alias("ct_dts"), (sign * F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))

    @property
    def holdings(self) -> DataFrame:
        return self.trades.filter("line = 'F'").select(F.col("t_id").alias("hh_t_id"), F.when(F.col("type") == "TMB", F.col("quantity")).otherwise(-F.col("quantity")).alias("change"))

    @cached_property
    def market(self) -> DataFrame:
        """Days of each symbol, written once."""
        unit = F.round(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("long")
        return tables.scratch(self.read("lineitem").groupBy(F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("symbol"), F.col("l_shipdate").cast("date").alias("day")).agg(F.min(unit).alias("low"), F.max(unit).alias("high")), "market")

    @property
    def watches(self) -> DataFrame:
        e = self.read("events").filter("event_type <> 'error'")
        return e.select(F.col("user_id").alias("customerid"), F.concat(F.lit("S"), (F.col("event_id") % 20).cast("string")).alias("symbol"), "ts", F.when(F.col("event_type") == "purchase", "CNCL").otherwise("ACTV").alias("action"))

    @property
    def prospects(self) -> DataFrame:
        """Three full snapshots; some people come and go, some change."""
        c, k = self.read("customer"), F.col("c_custkey")
        each = [
            c.filter((k + b) % 4 != 0).select(
                F.concat(F.lit("P"), k.cast("string")).alias("agencyid"), F.upper("c_name").alias("lastname"), F.initcap("c_mktsegment").alias("city"), F.when(k % 2 == 0, F.lit("")).alias("addressline2"),
                F.round(F.col("c_acctbal") * 300).cast("long").alias("networth"), F.when(k % 10 == 0, "none").otherwise(F.round(F.col("c_acctbal") * 30).cast("long").cast("string")).alias("income"), ((k + b) % 5).alias("numberchildren"), (k % 9).alias("numbercreditcards"),
                (k % 90).alias("age"), (k % 850).alias("creditrating"), (k % 6).alias("numbercars"), F.lit(b).alias("batchid"),
            )
            for b in (1, 2, 3)
        ]
        return union(each)

    def finwire(self, kind: str) -> DataFrame:
        """The fixed-width records of one kind (CMP, SEC, FIN), written as text and read back as lines; each kind has a folder of its own."""
        p, k = self.read("part"), F.col("p_partkey")
        name = lambda c: F.concat(F.lit("Company "), c.cast("string"))
        prefix = lambda day, kind: F.concat(F.date_format(day, "yyyyMMdd"), F.lit("-120000"), F.lit(kind))
        rating = lambda i: F.array(*[F.lit(x) for x in ("AAA", "BB+", "CC", "junk")])[((k / 5 + i) % 4).cast("int")]

        def line(df: DataFrame, layout, values: dict) -> DataFrame:
            cols = F.concat(*[F.rpad(F.coalesce(values.get(n, F.lit("")).cast("string"), F.lit("")), length, " ") for n, _, length, _ in layout])
            return df.select(F.concat(values["_prefix"], cols).alias("value"))

        firms = p.filter("p_partkey % 5 = 0")
        lines = []
        firm = k - k % 5
        for i, day in enumerate((F.lit("1993-01-01").cast("date"), F.date_add(F.lit("1998-01-01").cast("date"), (k % 100).cast("int")))):
            own = {"_prefix": prefix(day, "CMP"), "companyname": name(k), "cik": F.lpad(k.cast("string"), 10, "0"), "status": F.lit("ACTV"), "industryid": F.concat(F.lit("I"), (k % 3).cast("string")), "sprating": rating(i), "foundingdate": F.when(k % 7 == 0, "19001399").otherwise("19700102"), "ceo": F.col("p_brand")}
            lines += [line(firms, CMP, own)] if kind == "CMP" else []
        ref = F.when(k % 2 == 0, F.lpad(firm.cast("string"), 20, "0")).otherwise(name(firm))
        for day, more in ((F.lit("1994-06-01").cast("date"), 0), (F.lit("1999-06-01").cast("date"), 7)):
            own = {"_prefix": prefix(day, "SEC"), "symbol": F.concat(F.lit("S"), k.cast("string")), "issue": F.lit("COMMON"), "status": F.lit("ACTV"), "name": F.col("p_name"), "exchangeid": F.lit("NYSE"), "sharesoutstanding": k * 100 + more, "firsttrade": F.lit("19900105"), "dividend": F.lit("0.25"), "conameorcik": ref}
            lines += [line(p, SEC, own)] if kind == "SEC" else []
        day = F.col("l_shipdate")
        fin = self.read("lineitem").groupBy((F.col("l_partkey") - F.col("l_partkey") % 5).alias("firm"), F.year(day).alias("y"), F.quarter(day).alias("q")).agg(F.sum(F.round(F.col("l_extendedprice")).cast("long")).alias("revenue"))
        start = F.make_date("y", F.col("q") * 3 - 2, F.lit(1))
        own = {"_prefix": prefix(F.add_months(start, 3), "FIN"), "year": F.col("y"), "quarter": F.col("q"), "qtrstartdate": F.date_format(start, "yyyyMMdd"), "postingdate": F.date_format(F.add_months(start, 3), "yyyyMMdd"), "revenue": F.col("revenue"), "earnings": F.floor(F.col("revenue") / 4), "eps": F.floor(F.col("revenue") / 1000), "sharesout": F.lit(1000),
               "conameorcik": F.when(F.col("firm") % 2 == 0, F.lpad(F.col("firm").cast("string"), 20, "0")).otherwise(name(F.col("firm")))}
        lines += [line(fin, FIN, own)] if kind == "FIN" else []
        path = tables.scratch_path(self.spark, f"finwire_{kind}")
        union(lines).write.text(path)
        return files.split_record_types(self.spark.read.text(path))
