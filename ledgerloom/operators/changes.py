"""Applying changes: keyed tables (type 1), histories (type 2), carried state.

There is no MERGE without a table format, so a merge is a function of two frames: the rows
that hold and the changes give the next rows. Only keys that changed are worked on again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.history import forward_fill, forward_fill_blocks, latest, open_end, scd2_build


def all_of(*sources: DataFrame) -> DataFrame:
    """Several flows into one target."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def apply_changes(sources: Sequence[DataFrame], keys: Sequence[str], sequence_by: Sequence[str], scd: int = 1, ignore_nulls: bool = False, except_cols: Sequence[str] = (), delete_when: Column | None = None) -> DataFrame:
    """The table that a change feed gives.

    Type 1: one row per key, the last by ``sequence_by`` (with ``ignore_nulls`` each column
    keeps its last value that isn't null). Type 2: every version, with start_at and end_at
    (null while it holds). ``sequence_by`` must order the changes of a key totally; the order
    of arrival doesn't matter. A key whose last change is a delete is absent from type 1.
    """
    events = all_of(*sources)
    if delete_when is not None:
        events = events.withColumn("_gone", F.coalesce(delete_when, F.lit(False)))
    cols = [c for c in events.columns if c not in {*keys, *except_cols, "_gone"}]
    order = F.struct(*sequence_by)
    if scd == 1:
        if ignore_nulls:
            last = {c: F.max_by(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"))), F.when(F.col(c).isNotNull(), order))["v"] for c in cols}
        else:
            best = F.max_by(F.struct(*cols), order)
            last = {c: best[c] for c in cols}
        gone = [F.max_by("_gone", order).alias("_gone")] if delete_when is not None else []
        out = events.groupBy(*keys).agg(*[v.alias(c) for c, v in last.items()], *gone)
        return out.filter("NOT _gone").drop("_gone") if gone else out
    if ignore_nulls:
        events = forward_fill(events, keys, list(sequence_by), [c for c in cols if c not in sequence_by])
    w = Window.partitionBy(*keys).orderBy(*sequence_by)
    dated = events.withColumn("start_at", F.col(sequence_by[0])).withColumn("end_at", F.lead(sequence_by[0]).over(w))
    if delete_when is not None:
        dated = dated.filter("NOT _gone")
    return dated.filter("end_at IS NULL OR start_at < end_at").select(*keys, *cols, "start_at", "end_at")


def scd1_merge(target: DataFrame, changes: DataFrame, keys: Sequence[str], ts: Sequence[str], guard: Column | None = None, fill: bool = True) -> DataFrame:
    """Upsert: the last change of each key over the row that holds.

    ``guard`` is a condition on the target's columns; rows that fail it take no updates. With
    ``fill`` a change's nulls leave the target's values. A change older than the row that
    holds (by ``ts``, which the table keeps) is passed over.
    """
    news = latest(changes.select(*target.columns), keys, ts)
    new = news.withColumnsRenamed({c: f"_{c}" for c in target.columns})
    both = target.withColumn("_old", F.lit(True)).join(new.withColumn("_new", F.lit(True)), [target[k] == new[f"_{k}"] for k in keys], "full_outer")
    later = F.struct(*[F.col(f"_{c}") for c in ts]) >= F.struct(*[target[c] for c in ts])
    take = F.col("_new").isNotNull() & (F.col("_old").isNull() | (later & (F.lit(True) if guard is None else F.coalesce(guard, F.lit(False)))))
    value = lambda c: F.coalesce(F.col(f"_{c}"), target[c]) if fill else F.when(F.col("_new").isNotNull(), F.col(f"_{c}")).otherwise(target[c])
    return both.select(*[F.when(take, value(c)).otherwise(target[c]).alias(c) for c in target.columns])


def open_close_merge(target: DataFrame, changes: DataFrame, keys: Sequence[str], opened: str, closed: str) -> tuple[DataFrame, DataFrame]:
    """(next table, closes without an open row): a close fills the row that is open, an opening makes a new row.

    ``target`` and ``changes`` have a row per key and opening; a change that only closes has
    a null ``opened``. Rows closed before stay as they are.
    """
    done = target.filter(F.col(closed).isNotNull())
    held = target.filter(F.col(closed).isNull())
    ends = changes.filter(F.col(opened).isNull() & F.col(closed).isNotNull()).groupBy(*keys).agg(F.max(closed).alias("_closed"))
    kept = held.join(ends, [*keys], "left").withColumn(closed, F.coalesce(F.col(closed), F.col("_closed"))).select(*target.columns)
    lost = ends.join(held.select(*keys), [*keys], "left_anti")
    return done.unionByName(kept).unionByName(changes.filter(F.col(opened).isNotNull()).select(*target.columns)), lost


def with_told(events: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sparse events with the names of the columns that each tells."""
    return events.withColumn("told", F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in cols])))


def open_close_totals(target: DataFrame, changes: DataFrame, keys: Sequence[str], opened: str, closed: str) -> DataFrame:
    """One row per key: its first opening and last close over what the table holds and what changed, so that batches add up to the whole log."""
    both = target.select(*keys, opened, closed).unionByName(changes.select(*keys, opened, closed))
    return both.groupBy(*keys).agg(F.min(opened).alias(opened), F.max(closed).alias(closed))


def scd2_merge(target: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str], cols: Sequence[str], start: str = "effectivedate", end: str = "enddate") -> DataFrame:
    """The history after sparse changes: several a key and batch, out of order or delivered again, are all right.

    ``target`` keeps one row per version with its event's ``ts`` and ``seq``. Versions of keys
    that didn't change are passed through; those of changed keys are opened up as events,
    joined by the new ones, filled forward and dated anew. The rest of the table isn't read
    into the windows. Where ``target`` has a column ``told`` (``with_told``), it lists the columns
    that a version's day told itself: only these are events again, so that a late event's
    value goes on into later versions that didn't tell that column. Of an event that is
    delivered again the later delivery counts (among several the greatest), whatever the order of rows.
    """
    sparse = "told" in target.columns
    touched = changes.select(*keys).distinct()
    same = target.join(touched, [*keys], "left_anti")
    events = target.join(touched, [*keys], "left_semi")
    if sparse:
        events = events.withColumns({c: F.when(F.array_contains("told", c), F.col(c)) for c in cols})
        changes = with_told(changes, cols)
    rest = [*cols, *(["told"] if sparse else [])]
    events = events.select(*keys, ts, *seq, *rest, F.lit(0).alias("_new"))
    both = events.unionByName(changes.select(*keys, ts, *seq, *rest, F.lit(1).alias("_new")))
    best = F.max_by(F.struct(*rest), F.struct("_new", *rest))
    merged = both.groupBy(*keys, ts, *seq).agg(best.alias("_r")).select(*keys, ts, *seq, *[F.col("_r").getField(c).alias(c) for c in rest])
    if sparse:  # a day's last event stands for all that its day told
        day = Window.partitionBy(*keys, F.col(ts).cast("date")).orderBy(ts, *seq).rowsBetween(Window.unboundedPreceding, 0)
        merged = merged.withColumn("told", F.array_sort(F.array_distinct(F.flatten(F.collect_list("told").over(day)))))
    again = scd2_build(forward_fill(merged, keys, [ts, *seq], cols), keys, ts, seq, start, end)
    return same.select(*target.columns).unionByName(again.select(*target.columns))


def with_clocks(events: DataFrame, cols: Sequence[str], ts: str, seq: Sequence[str]) -> DataFrame:
    """Sparse events with a clock for each column: (ts, seq) of the event where it tells the column, else null."""
    return events.withColumn("clocks", F.struct(*[F.when(F.col(c).isNotNull(), F.struct(ts, *seq)).alias(c) for c in cols]))


def clocked_history(events: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str], cols: Sequence[str], start: str = "effectivedate", end: str = "enddate", block: Column | None = None) -> DataFrame:
    """The history that a log of sparse events gives, with its clocks, for ``clocked_merge`` to go on from: a version for each key and day with events."""
    return _by_day(with_clocks(events, cols, ts, seq).withColumn("_new", F.lit(1)), keys, ts, seq, cols, start, end, block)


def clocked_merge(target: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str], cols: Sequence[str], start: str = "effectivedate", end: str = "enddate", block: Column | None = None) -> DataFrame:
    """The history after more sparse events, however the events of a day are dealt over batches.

    A version keeps, for each column, the clock of the event of its day that told it
    (``clocks``; the value is carried where its clock is null). The columns of a day are
    merged each by its own clock, so batches may come in any order, a day's events in
    different ones, and again: of an event that is delivered again the later delivery counts.
    Only keys that changed go through windows.
    """
    touched = changes.select(*keys).distinct()
    same = target.join(touched, [*keys], "left_anti")
    held = target.join(touched, [*keys], "left_semi").withColumns({c: F.when(F.col("clocks")[c].isNotNull(), F.col(c)) for c in cols})
    need = [*keys, ts, *seq, *cols, "clocks"]
    both = held.select(*need, F.lit(0).alias("_new")).unionByName(with_clocks(changes, cols, ts, seq).select(*need, F.lit(1).alias("_new")))
    again = _by_day(both, keys, ts, seq, cols, start, end, block)
    return same.select(*again.columns).unionByName(again)


def _by_day(events: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str], cols: Sequence[str], start: str, end: str, block: Column | None) -> DataFrame:
    last = F.max(F.struct(ts, *seq))
    told = {c: F.max_by(F.struct(F.col(c).alias("v"), F.col("clocks")[c].alias("k")), F.when(F.col("clocks")[c].isNotNull(), F.struct(F.col("clocks")[c].alias("k"), "_new", F.col(c).alias("v")))) for c in cols}
    days = events.groupBy(*keys, F.col(ts).cast("date").alias(start)).agg(last.alias("_last"), *[v.alias(f"_{c}") for c, v in told.items()])
    rows = days.select(*keys, *[F.col("_last").getField(c).alias(c) for c in (ts, *seq)], *[F.col(f"_{c}.v").alias(c) for c in cols], F.struct(*[F.col(f"_{c}.k").alias(c) for c in cols]).alias("clocks"))
    filled = forward_fill(rows, keys, [ts, *seq], cols) if block is None else forward_fill_blocks(rows, keys, [ts, *seq], cols, block)
    return scd2_build(filled, keys, ts, seq, start, end, block)


def scd2_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str], day: str, cols: Sequence[str], start: str = "effectivedate", end: str = "enddate") -> DataFrame:
    """Changes of one day, at most one a key, as the rows to write: closed copies and new versions.

    Upserting them on (keys, start) gives what ``scd2_merge`` gives for ordered days.
    """
    held = target.filter("iscurrent").join(changes.select(*keys, F.col(day).alias("_day")), [*keys])
    closed = held.withColumn(end, F.col("_day")).withColumn("iscurrent", F.lit(False)).select(*target.columns)
    old = target.filter("iscurrent").select(*keys, *[F.col(c).alias(f"_{c}") for c in cols])
    new = changes.join(old, [*keys], "left").withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in cols} | {start: F.col(day), end: open_end(), "iscurrent": F.lit(True)})
    return closed.unionByName(new.select(*target.columns))


def patch_current(target: DataFrame, patches: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Attributes of current versions are changed in place, without a new version, where ``patches`` has the key."""
    hit = patches.select(*keys).distinct().withColumn("_hit", F.lit(True))
    rows = target.join(hit, [*keys], "left")
    on = F.col("iscurrent") & F.col("_hit").isNotNull()
    return rows.select(*[F.when(on, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns])


def carry_forward(state: DataFrame, new: DataFrame, keys: Sequence[str], day: str, amount: str, total: str = "balance") -> DataFrame:
    """Totals per key after a batch: old totals and new rows are summed up together; ``touched`` marks keys with new rows."""
    old = state.select(*keys, F.col(total).alias("_amount"), F.col(day), F.lit(False).alias("touched"))
    add = new.select(*keys, F.col(amount).alias("_amount"), F.col(day), F.lit(True).alias("touched"))
    return old.unionByName(add).groupBy(*keys).agg(F.sum("_amount").alias(total), F.max(day).alias(day), F.max("touched").alias("touched"))


def trade_lifecycle(history: DataFrame, keys: Sequence[str], ts: str, status: str, created: Sequence[str], closing: Sequence[str]) -> DataFrame:
    """From a status log: when a trade was created, its last status, and when it was closed (null while it is open)."""
    last = F.max(F.struct(ts, status))
    return history.groupBy(*keys).agg(
        F.coalesce(F.min(F.when(F.col(status).isin(*created), F.col(ts))), F.min(ts)).alias("create_ts"), last[status].alias("status"), F.when(last[status].isin(*closing), last[ts]).alias("close_ts"),
    )


def lifecycle_totals(target: DataFrame, changes: DataFrame, keys: Sequence[str], created: str, ts: str, status: str) -> DataFrame:
    """One row per key: its first ``created`` and its last (``ts``, ``status``) over what the table holds and what changed, in any order of batches."""
    cols = [*keys, created, ts, status]
    last = F.max(F.struct(ts, status))
    return target.select(*cols).unionByName(changes.select(*cols)).groupBy(*keys).agg(F.min(created).alias(created), last[ts].alias(ts), last[status].alias(status))
