"""Histories of keyed entities: forward fill, versions, as-of and overlap joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.clean import OPEN_END
from ledgerloom.operators.windows import lead_blocks

Order = Sequence[str | Column]


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def forward_fill(df: DataFrame, keys: Sequence[str], order: Order, cols: Sequence[str]) -> DataFrame:
    """Nulls of ``cols`` take the key's last value before them; ``order`` must be total within a key.

    All columns are filled by one window, so the rows of a key are sorted once.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def forward_fill_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], block: Column) -> DataFrame:
    """``forward_fill`` for keys that hold a great part of all rows.

    ``block`` cuts a key's rows into consecutive pieces (say, days of its first order column).
    Pieces are filled in tasks of their own; what each piece ends with is summed up before
    the shuffle, and only these ends, a row for each key and block, go through a window.
    """
    rows = df.withColumn("_block", block)
    inner = forward_fill(rows, [*keys, "_block"], order, cols)
    ends = rows.groupBy(*keys, "_block").agg(*[F.max_by(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"))), F.when(F.col(c).isNotNull(), F.struct(*order)))["v"].alias(c) for c in cols])
    w = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_block").alias("_b"), *[F.last(c, ignorenulls=True).over(w).alias(f"_{c}") for c in cols])
    on = [inner[k] == before[f"_{k}"] for k in keys]
    filled = inner.join(before, [*on, inner["_block"] == before["_b"]], "left")
    return filled.select(*[F.coalesce(inner[c], before[f"_{c}"]).alias(c) if c in cols else inner[c] for c in df.columns])


def scd2_build(df: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str] = (), start: str = "effectivedate", end: str = "enddate", block: Column | None = None) -> DataFrame:
    """Versions from an event log: half-open [start, end) in days, open end 9999-12-31, iscurrent.

    Events of one key on one day collapse to the last by (ts, *seq). Fill sparse events
    first (``forward_fill``), so that what a collapsed event told is kept. ``block`` (say, the
    year of ``ts``) deals the events of keys that hold a great part of all rows over tasks.
    """
    day = F.col(ts).cast("date")
    if block is None:
        led = df.withColumn("_next", F.lead(day).over(Window.partitionBy(*keys).orderBy(ts, *seq)))
    else:
        led = lead_blocks(df, keys, [ts, *seq], day, block, "_next")
    dated = led.withColumn(start, day).withColumn(end, F.coalesce("_next", open_end())).drop("_next")
    return dated.filter(F.col(start) < F.col(end)).withColumn("iscurrent", F.col(end) == open_end())


def scd2_last_of_day(df: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str] = (), start: str = "effectivedate", end: str = "enddate", block: Column | None = None) -> DataFrame:
    """``scd2_build`` in the other order: the last event of a day is picked before validity is drawn.

    Picking is an aggregation, so that a key with very many events comes to the window as
    one row a day.
    """
    picked = latest(df.withColumn(start, F.col(ts).cast("date")), [*keys, start], [ts, *seq])
    if block is None:
        led = picked.withColumn("_next", F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))
    else:
        led = lead_blocks(picked, keys, [start], F.col(start), block, "_next")
    dated = led.withColumn(end, F.coalesce("_next", open_end())).drop("_next")
    return dated.withColumn("iscurrent", F.col(end) == open_end())


def as_of_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str], t: str, start: str = "effectivedate", end: str = "enddate", how: str = "inner", bucket_days: int | None = None) -> DataFrame:
    """Each fact row with the version that holds at ``t``: start <= t < end.

    Equal keys drive the join, so Spark may broadcast or shuffle and split skewed keys; the
    validity is a residual condition. Versions of a key must not overlap. Where a key has
    very many versions, ``bucket_days`` adds the bucket of the day to the equal keys: a version
    then stands once in each bucket that it touches, within the days that facts have.
    """
    day = fact[t].cast("date")
    d = dim.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [fact[k] == d[f"_{k}"] for k in keys]
    valid = [d[start] <= day, day < d[end]]
    if bucket_days is None:
        return fact.join(d, [*on, *valid], how).drop(*[f"_{k}" for k in keys])
    number = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01")) / bucket_days)
    seen = fact.agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))  # one row
    inside = d.crossJoin(F.broadcast(seen)).filter((F.col(start) <= F.col("_hi")) & (F.col(end) > F.col("_lo")))
    spread = inside.withColumn("_bucket", F.explode(F.sequence(number(F.greatest(F.col(start), F.col("_lo"))), number(F.least(F.date_sub(end, 1), F.col("_hi")))))).drop("_lo", "_hi")
    on = [fact[k] == spread[f"_{k}"] for k in keys]
    return fact.join(spread, [*on, number(day) == spread["_bucket"], spread[start] <= day, day < spread[end]], how).drop("_bucket", *[f"_{k}" for k in keys])


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("iscurrent")


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], start: str = "effectivedate", end: str = "enddate", how: str = "inner", bucket_days: int | None = None) -> DataFrame:
    """Pairs of versions of equal keys that overlap, clipped to what they share.

    With ``how='left'`` a version without any overlap stays, with its own bounds; right
    columns other than the keys and bounds must not clash. Where a key has very many versions,
    ``bucket_days`` deals both sides to buckets of days: a version stands in each bucket that it
    touches (up to the last start there is), and a pair is told only in the bucket of its later start.
    """
    if bucket_days is not None:
        return _overlap_by_bucket(left, right, keys, start, end, how, bucket_days)
    r = right.withColumnsRenamed({k: f"_{k}" for k in keys} | {start: "_start", end: "_end"})
    on = [left[k] == r[f"_{k}"] for k in keys]
    both = left.join(r, [*on, left[start] < F.col("_end"), F.col("_start") < left[end]], how)
    clipped = both.withColumns({start: F.greatest(left[start], F.col("_start")), end: F.least(left[end], F.col("_end"))})
    return clipped.drop("_start", "_end", *[f"_{k}" for k in keys])


def _overlap_by_bucket(left: DataFrame, right: DataFrame, keys: Sequence[str], start: str, end: str, how: str, bucket_days: int) -> DataFrame:
    number = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01")) / bucket_days)
    last = left.select(start).unionByName(right.select(start)).agg(F.max(number(F.col(start))).alias("_last"))  # one row

    def dealt(df: DataFrame) -> DataFrame:
        sound = df.filter(F.col(start) < F.col(end)).crossJoin(F.broadcast(last))
        return sound.withColumn("_bucket", F.explode(F.sequence(number(F.col(start)), F.greatest(number(F.col(start)), F.least(number(F.date_sub(end, 1)), F.col("_last")))))).drop("_last")

    r = dealt(right).withColumnsRenamed({k: f"_{k}" for k in keys} | {start: "_start", end: "_end", "_bucket": "_rbucket"})
    own = dealt(left.withColumns({"_from": F.col(start), "_to": F.col(end)}))
    on = [own[k] == r[f"_{k}"] for k in keys]
    later = F.greatest(F.col("_from"), F.col("_start"))
    both = own.join(r, [*on, own["_bucket"] == r["_rbucket"], F.col("_from") < F.col("_end"), F.col("_start") < F.col("_to"), own["_bucket"] == number(later)])
    clipped = both.withColumns({start: later, end: F.least(F.col("_to"), F.col("_end"))})
    rest = [c for c in right.columns if c not in {*keys, start, end}]
    out = clipped.select(*left.columns, *rest)
    if how == "inner":
        return out
    met = clipped.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_from").alias("_k_from"), F.col("_to").alias("_k_to")).distinct()
    alone = left.join(met, [left[k] == met[f"_k_{k}"] for k in keys] + [left[start] == met["_k_from"], left[end] == met["_k_to"]], "left_anti")
    return out.unionByName(alone, allowMissingColumns=True)


def first_only(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key: the first by a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by a total order, by aggregation (summed up before the shuffle, not sorted)."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("r")).select(*keys, *[F.col("r").getField(c).alias(c) for c in rest]).select(*df.columns)


def cdc_flag(df: DataFrame, keys: Sequence[str], order: Order, flag: str = "cdc_flag") -> DataFrame:
    """I for the first event of a key, U for all later ones."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(flag, F.when(F.row_number().over(w) == 1, "I").otherwise("U"))


def to_change_feed(df: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Full rows per key and day from sparse events: filled, the last of each day, flagged I or U, with its day."""
    day = F.col(ts).cast("date")
    filled = forward_fill(df, keys, [ts, *seq], cols).withColumn("update_dt", day)
    return cdc_flag(latest(filled, [*keys, "update_dt"], [ts, *seq]), keys, ["update_dt"])


def open_close(df: DataFrame, keys: Sequence[str], action: str, ts: str, close: str, opened: str = "placed", closed: str = "removed") -> DataFrame:
    """Per key when it was first opened and last closed (by the action's value)."""
    return df.groupBy(*keys).agg(F.min(F.when(F.col(action) != close, F.col(ts))).alias(opened), F.max(F.when(F.col(action) == close, F.col(ts))).alias(closed))


def snapshot_diff(df: DataFrame, cols: Sequence[str], batch: str = "batchid") -> DataFrame:
    """Full snapshots collapse to distinct rows with the first and the last batch that has them."""
    return df.groupBy(*cols).agg(F.min(batch).alias("first_batch"), F.max(batch).alias("last_batch"))


def as_of_batch(diff: DataFrame, n: int) -> DataFrame:
    """What was known at batch ``n``; rows seen later still end there."""
    return diff.filter((F.col("first_batch") <= n) & (F.col("last_batch") >= n)).withColumn("last_batch", F.least(F.col("last_batch"), F.lit(n)))
