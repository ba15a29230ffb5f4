"""Running, trailing and extreme windows, and dense numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[str | Column]


def daily_totals(df: DataFrame, keys: Sequence[str], ts: str, amount: str, day: str = "day", total: str = "total") -> DataFrame:
    return df.groupBy(*keys, F.col(ts).cast("date").alias(day)).agg(F.sum(amount).alias(total))


def running_sum(df: DataFrame, keys: Sequence[str], order: Order, amount: str, out: str = "balance") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(amount).over(w))


def trailing_sum(df: DataFrame, keys: Sequence[str], order: Order, value: str, n: int = 4, include_current: bool = False, out: str = "trailing") -> DataFrame:
    """Sum of the ``n`` rows before (or up to) the current one; null where there is none."""
    frame = (-(n - 1), 0) if include_current else (-n, -1)
    return df.withColumn(out, F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)))


def _earliest(v: Column, day: Column) -> tuple[Column, Column]:
    """Structs whose smallest and largest value each stand on their earliest day; null where there is no value."""
    least, most = F.struct(v.alias("v"), day.alias("d")), F.struct(v.alias("v"), F.date_diff(F.lit("1970-01-01").cast("date"), day).alias("back"), day.alias("d"))
    return F.when(v.isNotNull(), least), F.when(v.isNotNull(), most)


def same(left: DataFrame, right: DataFrame, cols: Sequence[str], prefix: str = "_k_") -> list[Column]:
    """Equal columns, nulls too; ``right`` has them under ``prefix``."""
    return [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in cols]


def carried(df: DataFrame, keys: Sequence[str], block: str, aggs: dict[str, Column], over: dict[str, Column], before: bool = True) -> DataFrame:
    """``df`` with what the key's blocks before (or after) a row's own block say, by way of block totals.

    ``aggs`` sum a block up to one row (before the shuffle); ``over`` puts the blocks' rows together
    in a window of one row a block. So a key that holds a great part of all rows sends only its
    blocks through one task.
    """
    totals = df.groupBy(*keys, block).agg(*[v.alias(c) for c, v in aggs.items()])
    order = F.col(block) if before else F.col(block).desc()
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    told = totals.select(*[F.col(c).alias(f"_k_{c}") for c in (*keys, block)], *[v.over(w).alias(c) for c, v in over.items()])
    return df.join(told, same(df, told, [*keys, block]), "left").drop(*[f"_k_{c}" for c in (*keys, block)])


def over_key(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """``df`` with aggregates over all rows of its keys, as a window without an order tells them: summed up before the shuffle and joined, so that no key is a group of one task."""
    told = df.groupBy(*keys).agg(*[v.alias(c) for c, v in aggs.items()]).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return df.join(told, same(df, told, keys), "left").drop(*[f"_k_{k}" for k in keys])


def running_sum_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, block: Column, out: str = "balance") -> DataFrame:
    """``running_sum`` for keys that hold a great part of all rows; ``block`` cuts a key's rows into consecutive pieces (say, months of its first order column)."""
    rows = df.withColumn("_block", block)
    w = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.withColumn("_own", F.sum(amount).over(w))
    both = carried(inner, keys, "_block", {"_sum": F.sum(amount)}, {"_before": F.sum("_sum")})
    total = F.when(F.col("_own").isNull(), F.col("_before")).otherwise(F.col("_own") + F.coalesce("_before", F.lit(0)))
    return both.withColumn(out, total).select(*df.columns, out)


def lead_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, block: Column, out: str) -> DataFrame:
    """The next row's ``value`` of the key, for keys that hold a great part of all rows: a block's last row takes it from the next block's first."""
    rows = df.withColumns({"_block": block, "_value": value})
    own = F.lead(F.struct("_value")).over(Window.partitionBy(*keys, "_block").orderBy(*order))
    both = carried(rows.withColumn("_own", own), keys, "_block", {"_first": F.min(F.struct(*order, "_value"))}, {"_next": F.last("_first")}, before=False)
    return both.withColumn(out, F.when(F.col("_own").isNotNull(), F.col("_own._value")).otherwise(F.col("_next._value"))).select(*df.columns, out)


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, out: str = "idx") -> DataFrame:
    """0, 1, 2, … within each key; a key's blocks are numbered in tasks of their own."""
    rows = df.withColumn("_block", block)
    own = rows.withColumn("_own", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order)) - 1)
    both = carried(own, keys, "_block", {"_n": F.count("*")}, {"_before": F.sum("_n")})
    return both.withColumn(out, (F.col("_own") + F.coalesce("_before", F.lit(0))).cast("long")).select(*df.columns, out)


_LEAST, _MOST = "_lo", "_hi"


def rolling_extremes_by_month(asked: DataFrame, daily: DataFrame, monthly: DataFrame, keys: Sequence[str], day: str, days: int = 365) -> DataFrame:
    """``asked`` with the extremes of the ``days`` days up to each row's day, out of extremes by month.

    ``daily`` has rows with ``_lo``, ``_hi`` (``with_extremes``) of the months in which frames begin
    and end, ``monthly`` (keys, ``month_``, ``_lo``, ``_hi``) those of the months between; rows of
    other months don't matter. A frame is the end of its first month, whole months, and the
    beginning of its last month. Frames must be longer than a month.
    """
    if days < 32:
        raise ValueError("frames of less than a month")
    cols = asked.columns
    month, date = (lambda c: F.trunc(c, "month")), F.col(day)
    values = daily.select(*keys, F.col(day).alias("_at"), month(date).alias("month_"), _LEAST, _MOST)
    begin = F.date_sub(date, days - 1)
    # the beginning of the last month: of values and questions at one place values come first, so turned round by a negative place
    turned = lambda c: -F.datediff(c, F.lit("1970-01-01"))
    tops = extremes_from(values.withColumn("_at", turned(F.col("_at"))), asked.withColumns({"_at": turned(date), "month_": month(date)}), [*keys, "month_"], "_at").withColumnsRenamed({"_slo": "_plo", "_shi": "_phi"}).drop("_at", "month_")
    ends = extremes_from(values, tops.withColumns({"_at": begin, "month_": month(begin)}), [*keys, "month_"], "_at").drop("_at", "month_")
    # the whole months between: of each month of a key, what the months before it say, for the few numbers of months that a frame can touch
    nth = lambda c: F.year(c) * 12 + F.month(c)
    spans = range(days // 31, (days - 2) // 28 + 2)  # from the first month to the last
    told = [F.col(c).alias(f"_k_{c}") for c in keys]
    asked_months = ends.select(*told, nth(date).alias("_k_nth")).distinct().withColumns({c: F.lit(None).cast(monthly.schema[c].dataType) for c in (_LEAST, _MOST)})
    months = monthly.select(*told, nth("month_").alias("_k_nth"), _LEAST, _MOST).unionByName(asked_months).groupBy(*[f"_k_{c}" for c in keys], "_k_nth").agg(F.min(_LEAST).alias(_LEAST), F.max(_MOST).alias(_MOST))
    before = lambda f, c, n: f(c).over(Window.partitionBy(*[f"_k_{c}" for c in keys]).orderBy("_k_nth").rangeBetween(-(n - 1), -1)) if n > 1 else F.lit(None).cast(monthly.schema[c].dataType)
    held = months.select(*[f"_k_{c}" for c in keys], "_k_nth", *[before(f, c, n).alias(f"{out}{n}") for n in spans for f, c, out in ((F.min, _LEAST, "_blo"), (F.max, _MOST, "_bhi"))])
    number = nth(date) - nth(begin)
    pick = lambda out: F.coalesce(*[F.when(number == n, F.col(f"{out}{n}")) for n in spans])
    both = ends.join(held, [*same(ends, held, keys), nth(ends[day]) == held["_k_nth"]], "left").withColumns({"_blo": pick("_blo"), "_bhi": pick("_bhi")})
    return told_extremes(both.withColumns(merged_extremes(["_plo", "_blo", "_slo"], ["_phi", "_bhi", "_shi"])), cols)


def with_extremes(df: DataFrame, day: str, low: str, high: str) -> DataFrame:
    """``_lo`` and ``_hi``: structs whose smallest and largest each stand on their earliest day."""
    return df.withColumns({_LEAST: _earliest(F.col(low), F.col(day))[0], _MOST: _earliest(F.col(high), F.col(day))[1]})


def told_extremes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols, F.col("_lo.v").alias("low_value"), F.col("_lo.d").alias("low_day"), F.col("_hi.v").alias("high_value"), F.col("_hi.d").alias("high_day"))


def merged_extremes(lo: Sequence[str], hi: Sequence[str]) -> dict[str, Column]:
    """The extremes of several columns; nulls don't count."""
    pick = lambda f, cols: f(*cols) if len(cols) > 1 else F.col(cols[0])
    return {_LEAST: pick(F.least, lo), _MOST: pick(F.greatest, hi)}


def extremes_within(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """``_lo`` and ``_hi`` over the rows of the keys up to each row (those of the same ``pos`` too) as ``_plo``, ``_phi``."""
    w = Window.partitionBy(*keys).orderBy(pos).rangeBetween(Window.unboundedPreceding, 0)
    return df.withColumns({"_plo": F.min(_LEAST).over(w), "_phi": F.max(_MOST).over(w)})


def extremes_from(values: DataFrame, asked: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """Each row of ``asked`` with the extremes of the ``values`` of its keys from its ``pos`` on, as ``_slo``, ``_shi``.

    Values and questions are sorted together once, from the end: each question takes what came before it.
    """
    rest = [c for c in asked.columns if c not in {*keys, pos}]
    kind = "struct<" + ",".join(f"`{c}`:{asked.schema[c].dataType.simpleString()}" for c in rest) + ">"
    lo, hi = values.schema[_LEAST].dataType, values.schema[_MOST].dataType
    v = values.select(*keys, pos, F.lit(0).alias("_q"), _LEAST, _MOST, F.lit(None).cast(kind).alias("_row"))
    a = asked.select(*keys, pos, F.lit(1).alias("_q"), F.lit(None).cast(lo).alias(_LEAST), F.lit(None).cast(hi).alias(_MOST), F.struct(*rest).alias("_row"))
    w = Window.partitionBy(*keys).orderBy(F.col(pos).desc(), "_q").rowsBetween(Window.unboundedPreceding, 0)
    told = v.unionByName(a).select(*keys, pos, "_q", "_row", F.min(_LEAST).over(w).alias("_slo"), F.max(_MOST).over(w).alias("_shi"))
    return told.filter("_q = 1").select(*keys, pos, *[F.col("_row").getField(c).alias(c) for c in rest], "_slo", "_shi")


def _frames(df: DataFrame, keys: Sequence[str], pos: str, n: int) -> DataFrame:
    """Extremes over the last ``n`` positions, in time linear in the rows.

    Positions are cut into blocks of ``n``: a frame is the beginning of its row's block up to
    the row and the end of the block before. Both are cumulative frames in blocks of their
    own, so nothing is computed anew for each row and a key's blocks are dealt over tasks.
    """
    blocks = df.withColumn("_block", F.floor(F.col(pos) / n))
    begun = extremes_within(blocks, [*keys, "_block"], pos).drop(_LEAST, _MOST)
    asked = begun.withColumns({"_block": F.col("_block") - 1, "_at": F.col(pos) - (n - 1)})
    values = blocks.select(*keys, "_block", F.col(pos).alias("_at"), _LEAST, _MOST)
    both = extremes_from(values, asked, [*keys, "_block"], "_at")
    return both.withColumns(merged_extremes(["_plo", "_slo"], ["_phi", "_shi"]))


def rolling_extremes(df: DataFrame, keys: Sequence[str], day: str, low: str, high: str, rows: int | None = 365, days: int | None = None) -> DataFrame:
    """Lowest and highest value, each with the earliest day that has it, over the last ``rows`` rows or ``days`` days.

    The two differ where days are missing. With neither, over all rows so far. A key's rows
    are dealt over tasks by year or by frame; none is read by more than two frames.
    """
    cols, marked = df.columns, with_extremes(df, day, low, high)
    if days is not None:
        out = _frames(marked.withColumn("_pos", F.datediff(F.col(day), F.lit("1970-01-01")).cast("long")), keys, "_pos", days)
    elif rows is not None:
        out = _frames(row_index(marked, keys, [day], F.year(day), "_pos"), keys, "_pos", rows)
    else:
        inner = extremes_within(marked.withColumn("_block", F.year(day)), [*keys, "_block"], day)
        both = carried(inner, keys, "_block", {"_blo": F.min(_LEAST), "_bhi": F.max(_MOST)}, {"_clo": F.min("_blo"), "_chi": F.max("_bhi")})
        out = both.withColumns(merged_extremes(["_plo", "_clo"], ["_phi", "_chi"]))
    return told_extremes(out, cols)


def extremes_at(df: DataFrame, keys: Sequence[str], day: str, low: str, high: str, at: Column, days: int = 365) -> DataFrame:
    """Grouped form of ``rolling_extremes`` for one date: only the year before it is read and summed up."""
    span = df.filter((F.col(day) > F.date_sub(at, days)) & (F.col(day) <= at))
    least, _ = _earliest(F.col(low), F.col(day))
    _, most = _earliest(F.col(high), F.col(day))
    both = span.groupBy(*keys).agg(F.min(least).alias("lo"), F.max(most).alias("hi"))
    return both.select(*keys, F.col("lo.v").alias("low_value"), F.col("lo.d").alias("low_day"), F.col("hi.v").alias("high_value"), F.col("hi.d").alias("high_day"))


def top1(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def dense_index(df: DataFrame, order: Sequence[str], out: str = "idx") -> DataFrame:
    """0, 1, 2, … in the given total order, without sorting in one task.

    Rows are dealt by range and numbered within their partition; the partitions' sizes, a
    row for each partition, give the offsets. The dealt rows are numbered from one written
    copy, so that both passes see the same partitions.
    """
    from ledgerloom.sources.tables import scratch

    dealt = df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    dealt = scratch(dealt, "dealt")
    sizes = dealt.groupBy("_p").count()
    offsets = sizes.withColumn("_from", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_from")
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return dealt.withColumn("_own", own).join(offsets, "_p").withColumn(out, (F.col("_own") + F.col("_from")).cast("long")).drop("_p", "_own", "_from")


def top_rows(df: DataFrame, keys: Sequence[str], order: Order, n: int) -> DataFrame:
    """The first ``n`` rows of each key; each task keeps only so many a key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")
