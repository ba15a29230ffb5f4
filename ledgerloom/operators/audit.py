"""Row expectations, alerts, counts and checks over loaded tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerloom.operators.history import open_end
from ledgerloom.sources import tables


def expect(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Per expectation the rows that meet it, fail it, or can't tell; one pass over the rows."""
    names = list(conditions)
    counts = df.agg(*[F.count_if(conditions[n]).alias(f"ok_{i}") for i, n in enumerate(names)], *[F.count_if(~conditions[n]).alias(f"bad_{i}") for i, n in enumerate(names)], F.count("*").alias("n"))
    rows = F.array(*[F.struct(F.lit(n).alias("expectation"), F.col(f"ok_{i}").alias("passed"), F.col(f"bad_{i}").alias("failed"), (F.col("n") - F.col(f"ok_{i}") - F.col(f"bad_{i}")).alias("unknown")) for i, n in enumerate(names)])
    return counts.select(F.inline(rows))


class Observed:
    """Counts that the job which writes (or otherwise reads whole) a frame gathers on its way, so that no check reads it again.

    ``Observed(df, conditions)``: per expectation the rows that meet it, fail it, or can't
    tell, as ``expect`` does; with ``batches`` (values of a column) each is told by value too, as
    ``counters`` does. Use ``df`` of it in exactly one action, then ``expectations`` and ``counters``.
    """

    def __init__(self, df: DataFrame, conditions: Mapping[str, Column], batch: str | None = None, batches: Sequence = ()):
        self.names, self.batches, self.seen = list(conditions), list(batches), Observation()
        own = [F.count("*").alias("n")]
        for i, name in enumerate(self.names):
            own += [F.count_if(conditions[name]).alias(f"ok_{i}"), F.count_if(~conditions[name]).alias(f"bad_{i}")]
            own += [F.count_if(conditions[name] & (F.col(batch) == F.lit(b))).alias(f"ok_{i}_{k}") for k, b in enumerate(self.batches)]
        self.df = df.observe(self.seen, *own)
        self._spark = df.sparkSession

    def counts(self) -> list[tuple[str, int, int, int]]:
        """(expectation, passed, failed, unknown), after the action."""
        got = self.seen.get
        return [(n, got[f"ok_{i}"], got[f"bad_{i}"], got["n"] - got[f"ok_{i}"] - got[f"bad_{i}"]) for i, n in enumerate(self.names)]

    def expectations(self) -> DataFrame:
        return self._spark.createDataFrame(self.counts(), "expectation string, passed long, failed long, unknown long")

    def counters(self, dataset: str) -> DataFrame:
        """dataset, batchid, attribute, value as of ``counters``; a row for each of the batches asked for."""
        got = self.seen.get
        rows = [(dataset, b, n, got[f"ok_{i}_{k}"]) for k, b in enumerate(self.batches) for i, n in enumerate(self.names)]
        return self._spark.createDataFrame(rows, "dataset string, batchid long, attribute string, value long")


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def one_by_one(frames: Sequence[DataFrame], name: str) -> DataFrame:
    """``union`` of small results, each written by a job of its own: no two of them hold the disk for their shuffles at once."""
    path = tables.scratch_path(frames[0].sparkSession, name)
    for df in frames:
        tables.append(df.select(*frames[0].columns), path)
    return frames[0].sparkSession.read.schema(frames[0].schema).parquet(path)


def message(df: DataFrame, source: str, kind: str, text: str, data: Column) -> DataFrame:
    return df.select(F.lit(source).alias("source"), F.lit(kind).alias("kind"), F.lit(text).alias("message"), data.cast("string").alias("data"))


def row_counts(tables: Mapping[str, DataFrame], kind: str = "Validation") -> DataFrame:
    return union([message(t.agg(F.count("*").alias("n")), name, kind, "Row count", F.col("n")) for name, t in sorted(tables.items())])


def joined_count(name: str, fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], kind: str = "Validation") -> DataFrame:
    """Rows of a fact that find all their dimensions: a semi-join each, so a repeated key can't raise the count."""
    for dim, ref, key in dims:
        fact = fact.join(dim.select(F.col(key).alias(ref)).distinct(), ref, "left_semi")
    return message(fact.agg(F.count("*").alias("n")), name, kind, "Row count joined", F.col("n"))


def phase_record(spark, batch: int) -> DataFrame:
    return spark.range(1).select(F.lit("batch").alias("source"), F.lit("PCR").alias("kind"), F.lit("Batch complete").alias("message"), F.lit(str(batch)).alias("data"))


def alerts(rules: Sequence[tuple[str, str, DataFrame, Column, Column]]) -> DataFrame:
    """(source, message, rows, condition, what to tell): a message for each row that meets the condition."""
    return union([message(df.filter(cond), source, "Alert", text, data) for source, text, df, cond, data in rules])


def check(name: str, df: DataFrame, bad: Column) -> DataFrame:
    """test, result, failures: OK where no row is bad."""
    n = F.count_if(bad)
    return df.agg(n.alias("failures")).select(F.lit(name).alias("test"), F.when(F.col("failures") == 0, "OK").otherwise("Not OK").alias("result"), "failures")


def check_unique(name: str, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return check(name, df.groupBy(*cols).count(), F.col("count") > 1)


def check_domain(name: str, df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return check(name, df, ~F.coalesce(F.col(col).isin(*values), F.lit(False)))


def check_pattern(name: str, df: DataFrame, col: str, patterns: Sequence[str]) -> DataFrame:
    """Values (nulls aside) that match none of the LIKE patterns."""
    ok = reduce(lambda a, b: a | b, [F.col(col).like(p) for p in patterns])
    return check(name, df.filter(F.col(col).isNotNull()), ~ok)


def check_reference(name: str, df: DataFrame, ref: str, dim: DataFrame, key: str) -> DataFrame:
    lost = df.filter(F.col(ref).isNotNull()).join(dim.select(F.col(key).alias(ref)), ref, "left_anti")
    return check(name, lost, F.lit(True))


def check_contained(name: str, df: DataFrame, ref: str, start: str, end: str, dim: DataFrame, key: str) -> DataFrame:
    """Versions that don't lie within the validity of the version they refer to."""
    d = dim.select(F.col(key).alias("_k"), F.col("effectivedate").alias("_s"), F.col("enddate").alias("_e"))
    both = df.join(d, df[ref] == d["_k"], "left")
    return check(name, both, F.coalesce((F.col("_s") > df[start]) | (F.col("_e") < df[end]), F.lit(True)))


def check_scd2(name: str, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Five checks of a history: aligned, no overlap, reaches the end of time, no empty version, iscurrent means open.

    Neighbours are compared by one window; there is no self-join.
    """
    w = Window.partitionBy(*keys).orderBy("effectivedate")
    rows = dim.withColumns({"_next": F.lead("effectivedate").over(w), "_last": F.lead("effectivedate").over(w).isNull()})
    bad = {
        "aligned": F.col("_next").isNotNull() & (F.col("_next") != F.col("enddate")),
        "overlap": F.col("_next").isNotNull() & (F.col("_next") < F.col("enddate")),
        "end of time": F.col("_last") & (F.col("enddate") != open_end()),
        "empty version": F.col("effectivedate") >= F.col("enddate"),
        "iscurrent": F.col("iscurrent") != (F.col("enddate") == open_end()),
    }
    counts = rows.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(bad.values())])
    each = F.array(*[F.struct(F.lit(f"{name} {n}").alias("test"), F.when(F.col(f"c{i}") == 0, "OK").otherwise("Not OK").alias("result"), F.col(f"c{i}").alias("failures")) for i, n in enumerate(bad)])
    return counts.select(F.inline(each))


def check_window(name: str, df: DataFrame, day: str, batch: str, windows: DataFrame) -> DataFrame:
    """Dates outside their batch's window (batchid, first_day, last_day)."""
    both = df.join(windows, df[batch] == windows["batchid"], "left")
    return check(name, both, F.coalesce(~df[day].between(F.col("first_day"), F.col("last_day")), F.lit(True)))


def check_count(name: str, actual: DataFrame, expected: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Counts by key that differ from the expected ones, either side missing included."""
    e = expected.select(*keys, F.col(value).alias("_expected"))
    both = actual.join(e, [*keys], "full_outer")
    return check(name, both, ~F.col(value).eqNullSafe(F.col("_expected")))


def never_falls(name: str, counts: DataFrame, key: str, batch: str, value: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(batch)
    return check(name, counts.withColumn("_before", F.lag(value).over(w)), F.col("_before") > F.col(value))


def batches_complete(name: str, df: DataFrame, batch: str, wanted: Sequence[int]) -> DataFrame:
    have = df.select(F.col(batch).cast("long").alias("b")).distinct()
    want = df.sparkSession.createDataFrame([(int(b),) for b in wanted], "b long")
    return check(name, have.join(want.withColumn("_w", F.lit(True)), "b", "full_outer").join(have.withColumn("_h", F.lit(True)), "b", "left"), F.col("_w").isNull() | F.col("_h").isNull())


def counters(df: DataFrame, dataset: str, rules: Mapping[str, Column], batch: str = "batchid") -> DataFrame:
    """dataset, batchid, attribute, value: how many rows of each batch meet each rule."""
    names = list(rules)
    counts = df.groupBy(batch).agg(*[F.count_if(rules[n]).alias(f"c{i}") for i, n in enumerate(names)])
    each = F.array(*[F.struct(F.lit(n).alias("attribute"), F.col(f"c{i}").alias("value")) for i, n in enumerate(names)])
    return counts.select(F.lit(dataset).alias("dataset"), F.col(batch).alias("batchid"), F.inline(each))


def cumulative(counts: DataFrame, keys: Sequence[str], batch: str, value: str, out: str = "expected") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn(out, F.sum(value).over(w))


def completeness(groups: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """dataset, source_rows, target_rows of each (source, target): what joins or filters on the way have dropped or doubled."""
    none = F.lit(None).cast("long")
    one = lambda name, df, own: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("dataset"), *[(F.col("n") if c == own else none).alias(c) for c in ("source_rows", "target_rows")])
    both = one_by_one([one(name, df, own) for name, pair in groups.items() for df, own in zip(pair, ("source_rows", "target_rows"), strict=True)], "counts")
    return both.groupBy("dataset").agg(F.max("source_rows").alias("source_rows"), F.max("target_rows").alias("target_rows"))


def null_sweep(held: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """dataset, attribute, rows, nulls of the named columns; each table is read once."""

    def one(name: str, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        counts = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
        each = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col("n").alias("rows"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(cols)])
        return counts.select(F.lit(name).alias("dataset"), F.inline(each))

    return one_by_one([one(name, df, cols) for name, (df, cols) in held.items()], "nulls")


def check_tags(df: DataFrame, told: str, rules: Sequence[tuple[str, Column]], sep: str = "+") -> DataFrame:
    """tag, tagged, due, differ: rows that have each tag, rows that its rule gives it to, and rows where these differ."""
    has = lambda n: F.array_contains(F.split(told, F.lit(f"[{sep}]")), n)
    due = lambda c: F.coalesce(c, F.lit(False))
    counts = df.agg(*[f for i, (n, c) in enumerate(rules) for f in (F.count_if(has(n)).alias(f"a{i}"), F.count_if(due(c)).alias(f"b{i}"), F.count_if(has(n) != due(c)).alias(f"c{i}"))])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("tag"), F.col(f"a{i}").alias("tagged"), F.col(f"b{i}").alias("due"), F.col(f"c{i}").alias("differ")) for i, (n, _) in enumerate(rules)])))


def alert_counts(alerts: DataFrame, expected: DataFrame) -> DataFrame:
    """source, message, alerts, expected, result; a kind that either side lacks counts 0 there. ``expected`` has source, message, expected."""
    n = alerts.groupBy("source", "message").agg(F.count("*").alias("alerts"))
    both = n.join(expected, ["source", "message"], "full_outer").na.fill(0, ["alerts", "expected"])
    return both.withColumn("result", F.when(F.col("alerts") == F.col("expected"), "OK").otherwise("Not OK"))


def totals_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int, out: str) -> DataFrame:
    """keys, order, ``out``: the sum of the ``n`` rows before each, told from each row to the ``n`` after it; null for first rows.

    A second way to what a sliding window gives, to check it by.
    """
    placed = df.select(*keys, *order, value, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_n"))
    told = placed.select(*keys, F.explode(F.sequence(F.col("_n") + 1, F.col("_n") + n)).alias("_n"), value).groupBy(*keys, "_n").agg(F.sum(value).alias(out))
    return placed.drop(value).join(told, [*keys, "_n"], "left").select(*keys, *order, out)


def log_state(log: DataFrame, wanted: DataFrame, batch: str = "batchid") -> DataFrame:
    """Per wanted batch: its messages, the wanted sources without one, and the rows that it counts. ``log`` has batch, source, data; ``wanted`` batch, source."""
    counted = log.groupBy(batch, "source").agg(F.count("*").alias("_messages"), F.sum(F.col("data").try_cast("long")).alias("_rows"))
    both = wanted.distinct().join(counted, [batch, "source"], "left")
    return both.groupBy(batch).agg(F.coalesce(F.sum("_messages"), F.lit(0)).alias("messages"), F.count_if(F.col("_messages").isNull()).alias("missing"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"))
