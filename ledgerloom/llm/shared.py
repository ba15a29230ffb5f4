"""The folder that the driver and all executors share, and tables written to it.

Lineage is cut by writing a table there and reading it back: a lost executor
then costs only the tasks that were running on it.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_KEY = "spark.checkpoint.dir"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows after which an Arrow batch ends, unless the session says otherwise.
ARROW_BYTES = 4 << 20
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder of our own on one machine (tests), an error on a cluster."""
    named = spark.conf.get(_KEY, None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"{_KEY} must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    return _own[app]


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python some megabytes at a time, however long they are; a limit that the session sets itself stays."""
    if spark.conf.get(_BYTES, None) is None:
        spark.conf.set(_BYTES, str(ARROW_BYTES))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ledgerloom/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; its statistics are then known to the planner."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: A key with more rows than one in HOT_PART of all, and than FEW, is dealt over tasks of so many rows; there are at most HOT_PART such keys.
HOT_PART, FEW = 10_000, 256


def hot_keys(groups: DataFrame, keys: list[str], weight: str) -> DataFrame | None:
    """``keys, _salts``: hot keys and the number of salts that their rows are dealt over; None where there is no such key.

    ``groups`` has a row per key with its number of rows. The number of salts grows with a
    key's rows, so that no task gets more than one row in HOT_PART (or FEW), and the frame
    has fewer than HOT_PART rows at any size, which is why it may be broadcast.
    """
    total = groups.agg(F.sum(weight)).first()[0] or 0
    a_task = max(FEW, -(-total // HOT_PART))
    hot = groups.filter(F.col(weight) > a_task).select(*keys, F.ceil(F.col(weight) / a_task).cast("int").alias("_salts"))
    return None if hot.isEmpty() else hot


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame | None, spread: Column, how: str = "inner") -> DataFrame:
    """Equi-join in which ``left`` may have very many rows of the ``hot`` keys and ``right`` has few of each.

    Rows of hot keys are dealt by a hash of ``spread``; the right side stands once for each salt.
    """
    if hot is None:
        return left.join(right, keys, how)
    salts = F.broadcast(hot)
    salted = left.withColumn("_spread", F.xxhash64(spread)).join(salts, keys, "left").withColumn("_salt", F.coalesce(F.pmod("_spread", "_salts"), F.lit(0)).cast("int"))
    everywhere = right.join(salts, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
    return salted.drop("_spread", "_salts").join(everywhere.drop("_salts"), [*keys, "_salt"], how).drop("_salt")
