"""Where intermediate tables go, and the layouts in which tables are written."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share: ``spark.checkpoint.dir``; where it is unset, a folder of our own on one machine, an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _own.setdefault(spark.sparkContext.applicationId, "")
        if not root:
            root = _own[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{root.rstrip('/')}/ledgerloom/{uuid.uuid4().hex}/{name}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end; else these stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def scratch(df: DataFrame, name: str) -> DataFrame:
    """A written copy, for intermediates that several outputs read."""
    path = scratch_path(df.sparkSession, name)
    with freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a slice for each core: its shuffles take some hundred MB a core.
ROWS_A_CORE = 4_000_000


def by_slices(each: Callable[..., DataFrame], frames: Sequence[DataFrame], keys: Sequence[str], name: str, n: int | None = None) -> DataFrame:
    """A written ``each(*frames)``, for an ``each`` that works key by key, over one slice of the keys after the other.

    So the disk that shuffles take is that of a slice, however large the table. A slice is told by
    a hash of ``keys``, which all frames have; each slice reads the frames again, so they should be
    written tables. There are ``n`` slices, or as many as the rows of the first frame and the
    cluster's cores ask for: one if the table is small or the cluster large.
    """
    spark = frames[0].sparkSession
    if n is None:
        with freed(spark):
            n = max(1, -(-frames[0].count() // (ROWS_A_CORE * spark.sparkContext.defaultParallelism)))
    number, path = F.pmod(F.xxhash64(*keys), F.lit(n)), scratch_path(spark, name)
    for i in range(n):
        own = each(*[f.filter(number == i) if n > 1 else f for f in frames])
        with freed(spark):
            own.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(own.schema).parquet(path)


def write_snapshot(df: DataFrame, path: str, version: int, partition_by: Sequence[str] = ()) -> str:
    """One numbered version of a table; writing the same version again replaces it."""
    at = f"{path}/v={version}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(at)
    return at


def read_snapshot(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/v={version}")


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    with freed(df.sparkSession):
        df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    with freed(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_keys(df: DataFrame, path: str, key: str) -> None:
    """Replace just the key values that ``df`` has; the key is the partition column, so other days' files aren't touched.

    Rows are brought together by key, but a key with many rows (a daily batch has one key) is dealt over several tasks.
    """
    with freed(df.sparkSession):
        df.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def replace_where(df: DataFrame, path: str, key: str, value) -> None:
    """Replace one key value, also if ``df`` has fewer keys than before; rows of other keys in ``df`` are an error."""
    replace_keys(df.withColumn(key, F.when(F.col(key) == value, F.col(key)).otherwise(F.raise_error(F.lit(f"rows outside {key} = {value}")))), path, key)


def write_by_date(df: DataFrame, path: str, date_col: str, fmt: str = "parquet") -> None:
    """One folder per date, with one file unless the date has very many rows; the date stays in the data, since the folder's column is a copy."""
    with freed(df.sparkSession):
        df.withColumn("_pdate", F.col(date_col)).hint("rebalance", "_pdate").write.mode("overwrite").partitionBy("_pdate").format(fmt).save(path)


def write_change_files(df: DataFrame, path: str, date_col: str, rows_a_file: int = 1_000_000, sep: str = "|") -> None:
    """Change files as they come by day: a folder for each date with text files of its rows, the last column being the date.

    Dates are dealt over all tasks, since with few rows a day the cost is in the number of
    files; a date with more than ``rows_a_file`` rows is dealt over several. Tasks move their
    files to their place themselves, so the folder is complete only once it has its marker.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = df.groupBy(F.col(date_col).alias("_d")).count().filter(F.col("count") > rows_a_file)
    files = many.select("_d", F.ceil(F.col("count") / rows_a_file).alias("_files"))  # no more dates than the rows have days
    dealt = df.withColumn("_pdate", F.col(date_col)).join(F.broadcast(files), F.col("_pdate") == F.col("_d"), "left")
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if df.schema[c].dataType.simpleString() != "map"]), F.coalesce("_files", F.lit(1)))
    laid = dealt.withColumn("_salt", salt).repartition(n, "_pdate", "_salt").select(*df.columns, "_pdate")
    laid.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("_pdate").option("sep", sep).option("quote", "\u0000").option("emptyValue", "").option("nullValue", "").csv(path)


def split_at(df: DataFrame, ts: str, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """(history up to the cut-off, what comes by stream after it)."""
    return df.filter(F.col(ts) < cutoff), df.filter(F.col(ts) >= cutoff)


def clustered(df: DataFrame, path: str, by: str, n: int) -> None:
    """Files whose rows lie close by ``by``, so that its statistics prune them."""
    df.repartitionByRange(n, by).sortWithinPartitions(by).write.mode("overwrite").parquet(path)


def bucketed(df: DataFrame, keys: Sequence[str], n: int, name: str | None = None) -> DataFrame:
    """A catalog table in ``n`` buckets by ``keys``, sorted by them: joins and aggregations on the keys of tables with as many buckets need no exchange.

    Its files lie in the shared folder. Without a ``name`` the table has one of its own.
    """
    spark = df.sparkSession
    name = name or f"ledgerloom_{uuid.uuid4().hex}"
    df.repartition(n, *keys).write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys).option("path", scratch_path(spark, "bucketed")).saveAsTable(name)
    return spark.table(name)


#: Bits of each column in a space-filling key.
KEY_BITS = 16


def space_filling(cols: Sequence[Column]) -> Column:
    """One number out of several from 0 to 2 ** KEY_BITS - 1: their bits in turn, so that rows that are close by it are close by all of them."""
    return sum((F.shiftleft(F.shiftright(c.cast("long"), b).bitwiseAND(1), b * len(cols) + i) for i, c in enumerate(cols) for b in range(KEY_BITS)), F.lit(0).cast("long"))


def _spread(value: Column, edges: list[float], top: int) -> Column:
    """Numbers from 0 to ``top``, as many between each two edges as between any others; null is 0."""
    if len(edges) < 2:
        return F.lit(0)
    passed = F.size(F.filter(F.array(*[F.lit(x) for x in edges[1:-1]]), lambda x: x <= value)) if len(edges) > 2 else F.lit(0)
    low, high = (F.element_at(F.array(*[F.lit(x) for x in own]), passed + 1) for own in (edges[:-1], edges[1:]))
    inside = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (value - low) / (high - low)))
    return F.coalesce(F.floor((passed + inside) / (len(edges) - 1) * top), F.lit(0))


def clustered_by_all(df: DataFrame, path: str, by: Sequence[str], n: int) -> None:
    """Files whose rows lie close by each of several columns (numbers, dates or times), so that a predicate on any of them prunes files.

    Columns are spread evenly between their quantiles, so that a skewed one prunes too; nulls come first.
    """
    number = {c: (F.unix_date(c) if df.schema[c].dataType.simpleString() == "date" else F.col(c).cast("timestamp") if df.schema[c].dataType.simpleString().startswith("timestamp") else F.col(c)).cast("double") for c in by}
    told = df.select(*[v.alias(c) for c, v in number.items()])
    cuts = told.stat.approxQuantile(list(by), [i / 256 for i in range(257)], 0.002)  # 257 numbers a column
    top = (1 << KEY_BITS) - 1
    place = [_spread(number[c], sorted({*cut}), top) for c, cut in zip(by, cuts, strict=True)]
    df.withColumn("_z", space_filling(place)).repartitionByRange(n, "_z").sortWithinPartitions("_z").drop("_z").write.mode("overwrite").parquet(path)


def sized(df: DataFrame, path: str, bytes_per_row: int, file_bytes: int = 128 << 20, fmt: str = "parquet") -> None:
    """Files of about a given size, by rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max(1, file_bytes // bytes_per_row)).format(fmt).save(path)


def write_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    """Text without quotes; null is empty."""
    df.write.mode("overwrite").option("sep", sep).option("quote", "\u0000").option("emptyValue", "").option("nullValue", "").csv(path)


def recode(spark: SparkSession, source: DataFrame, path: str, files: int) -> DataFrame:
    """Text to Parquet in a given number of files."""
    source.repartition(files).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
