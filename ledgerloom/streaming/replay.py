"""Incremental runs: tables that bounded streams keep up, restartable at every point.

``fold`` keeps a table that each micro-batch computes anew from what it was (``Target``);
``append_facts`` keeps a fact by date to which each micro-batch adds (``DailyParts``). In both a
micro-batch writes a folder of its own, named by its number, and one commit at the end makes
it count: a batch that runs again replaces its own folder, and a reader sees all of a
micro-batch or nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.audit import Observed
from ledgerloom.sources.tables import freed, scratch

Step = Callable[[DataFrame, DataFrame], DataFrame]


def run_stream(source: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """All that the source has now, in micro-batches, then stop."""
    run = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()


class _Files:
    """Listing and deleting in the shared folder, by the session's own file system."""

    def __init__(self, spark: SparkSession):
        self.conf, self.path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path

    def _at(self, path: str):
        p = self.path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str, prefix: str = "") -> list[str]:
        fs, p = self._at(path)
        found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n.removeprefix(prefix) for n in found if n.startswith(prefix))

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


#: Buckets of a target; a table of 100 TB wants some ten thousand.
BUCKETS = 16


class Target:
    """A table in buckets by a hash of its keys.

    ``home/table/version_=7/bucket_=3`` is bucket 3 as micro-batch 7 left it, and
    ``home/commits/7`` says for every bucket which version holds after that batch. The commit is
    written last, so that all buckets of a micro-batch count at once or none.
    """

    def __init__(self, spark: SparkSession, home: str, seed: DataFrame, keys: Sequence[str] | None, buckets: int, before: Target | None = None):
        self.spark, self.home, self.schema, self.files = spark, home, seed.schema, _Files(spark)
        self.number = F.pmod(F.xxhash64(*keys), F.lit(buckets)) if keys else F.lit(0)
        #: Commits that have been read or written, by this or by the same table in the session before.
        self._known: dict[int, dict[int, int]] = before._known if before else {}
        if before is None and not self.commits():
            self.write(seed, [], -1)

    def commits(self) -> list[int]:
        """Numbers of micro-batches that are complete; an unfinished commit has no marker."""
        found = sorted(int(n) for n in self.files.names(f"{self.home}/commits"))
        while found and not self.files.exists(f"{self.home}/commits/{found[-1]}/_SUCCESS"):
            found.pop()  # only the last one can be unfinished
        return found

    def versions(self, n: int) -> dict[int, int]:
        """Bucket -> version after micro-batch ``n``: one row a bucket."""
        if n not in self._known:
            self._known[n] = {r.bucket: r.version for r in self.spark.read.schema("bucket long, version long").parquet(f"{self.home}/commits/{n}").collect()}
        return self._known[n]

    def write(self, rows: DataFrame, buckets: list[int], version: int) -> None:
        """Whole buckets as one version, then its commit; what only batches before the last one could need is deleted."""
        before = [n for n in self.commits() if n < version]
        held = self.versions(before[-1]) if before else {}
        at = f"{self.home}/table/version_={version}"
        with freed(rows.sparkSession):
            rows.select(*self.schema.names).withColumn("bucket_", self.number).hint("rebalance", "bucket_").write.mode("overwrite").partitionBy("bucket_").parquet(at)
        now = {b: v for b, v in held.items() if b not in {*buckets}} | {int(b): version for b in self.files.names(at, "bucket_=")}
        self.spark.createDataFrame([*now.items()], "bucket long, version long").coalesce(1).write.mode("overwrite").parquet(f"{self.home}/commits/{version}")
        self._known[version] = now
        self._clean(before[-2:-1], {*held.items()} | {*now.items()})

    def _clean(self, past: list[int], needed: set[tuple[int, int]]) -> None:
        """Versions that neither the last commit nor the one before it names go: whole folders in one call where nothing of them is needed."""
        gone = [(b, v) for n in past for b, v in self.versions(n).items() if (b, v) not in needed]
        kept = {v for _, v in needed}
        dead = {f"version_={v}" if v not in kept else f"version_={v}/bucket_={b}" for b, v in gone} | {f"version_={n}" for n in past if n not in kept}
        for at in sorted(dead):
            self.files.delete(f"{self.home}/table/{at}")
        for n in past:
            self.files.delete(f"{self.home}/commits/{n}")

    def read(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """The table after the last commit (before micro-batch ``before``): these buckets, or all."""
        done = [n for n in self.commits() if before is None or n < before]
        held = self.versions(done[-1]) if done else {}
        paths = [f"{self.home}/table/version_={v}/bucket_={b}" for b, v in sorted(held.items()) if buckets is None or b in {*buckets}]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)


def fold(
    source: DataFrame, seed: DataFrame, step: Step, home: str, keys: Sequence[str] | None = None, buckets: int = BUCKETS, prepare: Callable[[DataFrame], DataFrame] | None = None, changes: Sequence[str] | None = None,
) -> DataFrame:
    """``step(table, batch) -> table`` over all micro-batches of ``source``; returns the last table.

    ``step`` must work key by key: it is given the buckets of ``keys`` that the batch touches,
    and only these are written again (without ``keys`` the whole table). ``prepare`` turns a
    batch into rows that have the keys. What the last two commits name is kept, for batches
    that run again; older versions are deleted. Tables lie in ``home``; a later call goes on
    from there. ``seed`` is version -1.

    With ``changes`` (columns) each micro-batch also writes the rows of the table that it made
    or changed to ``home/changes/batch_=n``, for another stream to read (``changes_of``). A batch
    that runs again writes them again, so what reads them must take rows twice without harm.
    """
    spark = source.sparkSession
    first = Target(spark, home, seed, keys, buckets)

    def each(batch: DataFrame, n: int) -> None:
        own = Target(batch.sparkSession, home, seed, keys, buckets, first)
        rows = scratch(prepare(batch), "prepared") if prepare else batch
        touched = sorted(r[0] for r in rows.select(own.number).distinct().collect())  # at most ``buckets`` numbers
        if touched:
            held = own.read(touched, before=n)
            own.write(step(held, rows), touched, n)
            if changes:
                now = own.read(touched).select(*changes)
                with freed(now.sparkSession):
                    now.exceptAll(held.select(*changes)).write.mode("overwrite").parquet(f"{home}/changes/batch_={n}")

    run_stream(source, each, f"{home}/checkpoint")
    return Target(spark, home, seed, keys, buckets).read()


def changes_of(spark: SparkSession, home: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """A stream of the rows that a folded table's micro-batches made or changed."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{home}/changes/batch_=*")


Combine = Callable[[DataFrame], DataFrame]


class DailyParts:
    """A fact by date (or another ``key``) in parts.

    ``path/part_=7/day=2024-01-05`` is what micro-batch 7 told about that date; ``path/part_=7w/day=…``
    is the whole date up to micro-batch 7, in place of all its parts up to then. A part
    counts once its folder is complete. A date may come in any number of micro-batches: its
    rows are those of its live parts, put together by ``combine`` where the fact is a sum over
    them (a partial aggregate of partial aggregates) or simply all of them.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, combine: Combine | None = None):
        self.spark, self.path, self.key, self.combine, self.files = spark, path, key, combine, _Files(spark)

    def write(self, rows: DataFrame, n: int) -> None:
        """Micro-batch ``n``'s part; written again it replaces itself. A date with many rows is dealt over several tasks."""
        with freed(rows.sparkSession):
            rows.hint("rebalance", self.key).write.mode("overwrite").partitionBy(self.key).parquet(f"{self.path}/part_={n}")

    def _complete(self) -> list[str]:
        """Names of parts that count: a micro-batch's with its marker; whole dates are moved to their place each at once."""
        return [p for p in self.files.names(self.path, "part_=") if p.endswith("w") or self.files.exists(f"{self.path}/part_={p}/_SUCCESS")]

    def live(self) -> dict[str, list[str]]:
        """Folder of each date -> its live parts: the last whole one and those after it. A name for each date and part."""
        held: dict[str, dict[str, int]] = {}
        for part in self._complete():
            for day in self.files.names(f"{self.path}/part_={part}", f"{self.key}="):
                held.setdefault(day, {})[part] = int(part.removesuffix("w"))
        out = {}
        for day, parts in held.items():
            last = max((n for p, n in parts.items() if p.endswith("w")), default=None)
            out[day] = sorted(p for p, n in parts.items() if last is None or n > last or p == f"{last}w")
        return out

    def _rows(self, parts: dict[str, list[str]], schema) -> DataFrame:
        paths = [f"{self.path}/part_={p}/{self.key}={day}" for day, ps in sorted(parts.items()) for p in ps]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
        return rows.select(*(StructType.fromDDL(schema) if isinstance(schema, str) else schema).names)

    def read(self, schema, days: Sequence[str] | None = None) -> DataFrame:
        """The fact, or these dates of it; only folders of live parts are listed and read."""
        parts = {d: p for d, p in self.live().items() if days is None or d in days}
        rows = self._rows(parts, schema)
        return self.combine(rows) if self.combine else rows

    def compact(self, schema, parts: int = 2) -> None:
        """Dates with at least so many live parts become whole ones; what they stand for is deleted at the next call.

        Run again, or after a failure, it changes nothing that a reader sees.
        """
        live = self.live()
        self._clean(live)
        many = {d: p for d, p in live.items() if len(p) >= parts}
        by_last: dict[int, dict[str, list[str]]] = {}
        for d, p in many.items():
            by_last.setdefault(max(int(x.removesuffix("w")) for x in p), {})[d] = p
        for n, own in by_last.items():  # as many as there are last micro-batches, not dates
            self._add_whole(self._combined(own, schema), n)

    def _combined(self, parts: dict[str, list[str]], schema) -> DataFrame:
        rows = self._rows(parts, schema)
        return self.combine(rows) if self.combine else rows

    def _add_whole(self, rows: DataFrame, n: int) -> None:
        """Whole dates beside those that a whole part of that number has already."""
        with freed(rows.sparkSession):
            rows.hint("rebalance", self.key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.key).parquet(f"{self.path}/part_={n}w")

    def replace(self, rows: DataFrame) -> None:
        """Whole dates told anew, in place of all that came so far; later micro-batches add to them."""
        numbers = [int(p.removesuffix("w")) for p in self.files.names(self.path, "part_=")]
        self._add_whole(rows, max(numbers, default=-1))

    def _clean(self, live: dict[str, list[str]]) -> None:
        for part in self._complete():
            days = self.files.names(f"{self.path}/part_={part}", f"{self.key}=")
            dead = [d for d in days if part not in live[d]]
            for at in [""] if dead == days else [f"/{self.key}={d}" for d in dead]:
                self.files.delete(f"{self.path}/part_={part}{at}")


def append_facts(source: DataFrame, enrich: Callable[[DataFrame], DataFrame], parts: DailyParts, checkpoint: str, after=None, expectations: Mapping[str, Column] | None = None) -> None:
    """A fact by date: each micro-batch is enriched from tables and adds its part; ``after`` skips what history has.

    The same date may come in several micro-batches and in any order. A batch that runs
    again replaces its own part. ``expectations`` are counted by the job that writes the part,
    and kept by micro-batch beside the fact (``expected``).
    """

    def each(batch: DataFrame, n: int) -> None:
        rows = enrich(batch if after is None else batch.filter(F.col(parts.key) > F.lit(after)))
        own = DailyParts(batch.sparkSession, parts.path, parts.key)
        if expectations is None:
            own.write(rows, n)
            return
        seen = Observed(rows, expectations)
        own.write(seen.df, n)
        seen.expectations().coalesce(1).write.mode("overwrite").parquet(f"{parts.path}/counts/batch_={n}")

    run_stream(source, each, checkpoint)


def expected(parts: DailyParts) -> DataFrame:
    """What the expectations of ``append_facts`` have counted over all micro-batches."""
    told = parts.spark.read.schema("expectation string, passed long, failed long, unknown long, batch_ int").parquet(f"{parts.path}/counts")
    return told.groupBy("expectation").agg(*[F.sum(c).alias(c) for c in ("passed", "failed", "unknown")])


def reprocess(feed: DataFrame, day, enrich: Callable[[DataFrame], DataFrame], parts: DailyParts) -> None:
    """Compute one date again from its feed and replace all its parts."""
    parts.replace(enrich(feed.filter(F.col(parts.key) == F.lit(day))))


def newer_than_target(feed: DataFrame, day_col: str, target: DataFrame, target_day: str) -> DataFrame:
    """Only rows after the last date that the target has; all if it is empty."""
    last = target.agg(F.max(target_day).alias("_last"))
    return feed.crossJoin(last).filter(F.col("_last").isNull() | (F.col(day_col) > F.col("_last"))).drop("_last")  # one row on the right


def seeded(history: DataFrame, parts: DailyParts) -> None:
    """One-off backfill before a stream starts: written only where nothing is."""
    if not parts.live():
        parts.write(history, -1)
