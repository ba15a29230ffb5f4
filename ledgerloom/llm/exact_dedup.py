"""Operator 4, exact deduplication: a stream keeps disk-backed keyed state that never expires.

Every row's fingerprint (digest of its normalised text, document id, content locator)
lands in a source folder. A stream over that folder keeps, per digest, the smallest
identifier with its locator and the number of rows, in the RocksDB state store and
without a watermark, so that a later call with the same ``home`` goes on from there.
Rows that hit a known digest are compared with the keeper's whole text, found by its
locator; rows whose bytes differ (a digest collision) are grouped again by their text.
Only DataFrame and streaming functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import shared

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CONF = {
    "spark.sql.streaming.stateStore.providerClass": _ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores: no preallocated logs
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalized(text: Column) -> Column:
    """Every run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` read straight from files, so that each row has a locator (file, row number)."""
    try:
        docs.select(docs.metadataColumn("_metadata").getField("row_index"))
    except AnalysisException:
        return shared.materialize(docs, "located")
    return docs


def _rows(docs: DataFrame, digest: Callable[[Column], Column], text: bool) -> DataFrame:
    at = docs.metadataColumn("_metadata")
    norm = normalized(docs["text"])
    cols = [digest(norm).alias("digest"), docs["doc_id"].cast("long").alias("doc_id"), at.getField("file_path").alias("file"), at.getField("row_index").alias("row")]
    return docs.select(*cols, *([norm.alias("norm")] if text else []))


def _rank(row: str = "") -> Column:
    """Rows in keeping order: the smallest id first, null ids last, then the locator."""
    c = lambda n: F.col(row + n)
    return F.struct(c("doc_id").isNull().alias("no_id"), c("doc_id").alias("doc_id"), c("file").alias("file"), c("row").alias("row"))


def update_state(spark: SparkSession, fingerprints: DataFrame, home: str) -> DataFrame:
    """Append fingerprints to ``home``'s source folder, run the stream over what is new, return the whole state."""
    fingerprints.write.mode("append").parquet(f"{home}/landed")
    before = {k: spark.conf.get(k, None) for k in _CONF}
    try:
        for k, v in _CONF.items():
            spark.conf.set(k, v)
        state = (
            spark.readStream.schema(fingerprints.schema).parquet(f"{home}/landed")
            .groupBy("digest").agg(F.min(_rank()).alias("keep"), F.count("*").alias("n"))
        )
        run = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start()
        run.awaitTermination()
        kept = spark.read.format("statestore").load(f"{home}/state")
        buffers = kept.schema["value"].dataType.names
        return shared.materialize(kept.select(F.col("key.digest").alias("digest"), F.col(f"value.{buffers[0]}").alias("keep"), F.col(f"value.{buffers[1]}").alias("n")), "state")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exact_dedup(docs: DataFrame, home: str | None = None, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; other columns are not looked at).

    Returns file, row (the locator), doc_id, keep_id, group_size, kept, text_sha256.
    Null and empty texts are equal to each other and form one group. Of rows with equal
    texts the smallest doc_id stays, null ids last; rows that repeat an id are told
    apart by their locator, so exactly one row of each group is kept. An empty table
    gives no rows. With ``home``, earlier calls' documents count as well: ids of the
    keepers are then compared with all that came before.
    """
    spark = docs.sparkSession
    docs = located(docs)
    fresh, home = home is None, home or shared.new_path(spark, "dedup")
    landed = _rows(docs, digest, text=False)
    state = update_state(spark, landed, home)
    many = state.filter("n > 1")
    contents = _rows(docs, digest, text=True)
    if not fresh:  # keepers of earlier calls are found by their locators
        files = [r[0] for r in many.select("keep.file").distinct().collect()]
        earlier = sorted({*files} - {*docs.inputFiles()})
        if earlier:
            contents = contents.unionByName(_rows(spark.read.parquet(*earlier), digest, text=True).join(many.select(F.col("keep.file").alias("file"), F.col("keep.row").alias("row")), ["file", "row"], "left_semi").select("digest", "doc_id", "file", "row", "norm"))
    # only rows of groups of two and more; written once, since keepers and hits both come from it
    hot = shared.hot_keys(state, ["digest"], "n")
    row = F.struct("file", "row")
    texts = shared.materialize(shared.salted_join(contents, many.select("digest", "keep"), ["digest"], hot, row), "copies")
    rank = _rank()
    keepers = texts.filter(rank == F.col("keep")).select("digest", F.col("norm").alias("kept_norm"))
    hits = texts.filter(rank != F.col("keep"))
    odd = shared.materialize(
        shared.salted_join(hits, keepers, ["digest"], hot, row, "left").filter(~F.col("norm").eqNullSafe(F.col("kept_norm"))).select("digest", "doc_id", "file", "row", "norm"), "collided"
    )
    rows = spark.read.schema(landed.schema).parquet(f"{home}/landed") if fresh else landed
    sha = F.hex(F.col("digest")) if digest is sha256 else None
    if sha is None:
        rows = _rows(docs, digest, text=True).withColumn("sha", F.sha2("norm", 256)).drop("norm")
        sha = F.col("sha")
    out = shared.salted_join(rows, many, ["digest"], hot, row, "left").withColumn("n", F.coalesce("n", F.lit(1)))
    if odd.isEmpty():
        out = out.withColumn("keep", F.coalesce("keep", rank))
    else:  # the digest collided: the bytes decide
        again = odd.groupBy("digest", "norm").agg(F.min(rank).alias("own_keep"), F.count("*").alias("own_n"))
        placed = odd.join(again, ["digest", "norm"]).select("digest", "file", "row", "own_keep", "own_n")
        fewer = odd.groupBy("digest").agg(F.count("*").alias("away"))
        out = (
            out.join(placed, ["digest", "file", "row"], "left").join(fewer, "digest", "left")
            .withColumn("keep", F.coalesce("own_keep", "keep", rank)).withColumn("n", F.coalesce("own_n", F.col("n") - F.coalesce("away", F.lit(0))))
        )
    return out.select("file", "row", "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").cast("long").alias("group_size"), (F.col("keep") == rank).alias("kept"), F.lower(sha).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they were."""
    docs = located(docs)
    gone = exact_dedup(docs).filter("NOT kept").select("file", "row")
    at = docs.metadataColumn("_metadata")
    return docs.join(gone, (at.getField("file_path") == gone["file"]) & (at.getField("row_index") == gone["row"]), "left_anti")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(shared.read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
