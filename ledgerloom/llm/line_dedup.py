"""Operator 11, removal of lines that many documents share.

Texts are cut into lines with their positions; a line's key (stripped and lower-cased) is
hashed, distinct documents are counted per hash, and lines over the threshold are dropped
everywhere but in the document with the largest id. Only hashes and positions are dealt
out; the texts meet the positions that they lose once, and what stays is joined in order.
Hashes have 128 bits. Only DataFrame functions are used.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import shared
from ledgerloom.llm.exact_dedup import located

MIN_CHARS = 20
MIN_DOCS = 3
_BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """White space at both ends goes, A-Z become small."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _keyed(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc, file, row, pos, key (a hash) of every line that is long enough to be judged."""
    at = docs.metadataColumn("_metadata")
    lines = docs.select(docs["doc_id"].cast("long").alias("doc"), F.xxhash64(at.getField("file_path")).alias("file"), at.getField("row_index").alias("row"), F.posexplode(F.transform(_lines(docs["text"]), line_key)).alias("pos", "line"))
    return lines.filter(F.length("line") >= min_chars).select("doc", "file", "row", "pos", F.unhex(F.md5("line")).alias("key"))


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``key, keep, docs, lines``: hashes found in at least ``min_docs`` documents, the largest id that holds them, their documents and lines."""
    by_doc = _keyed(docs, min_chars).groupBy("key", "doc").agg(F.count("*").alias("lines"))
    return by_doc.groupBy("key").agg(F.max("doc").alias("keep"), F.count("*").alias("docs"), F.sum("lines").alias("lines")).filter(F.col("docs") >= min_docs)


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` per row of ``docs`` (``doc_id``, ``text``; other columns are not looked at).

    Null and empty texts are one empty line, which stays; the text is then empty. Rows
    that repeat an id are one document where documents are counted, and each gets a row of
    its own; rows without an id are together one document, smaller than all others. In the
    document that keeps a line all its copies stay. Very long texts are taken whole; a text
    that loses every line is empty. An empty table gives no rows.
    """
    docs = located(docs)
    bad = shared.materialize(shared_lines(docs, min_chars, min_docs), "shared_lines")
    hot = shared.hot_keys(bad, ["key"], "lines")
    met = shared.salted_join(_keyed(docs, min_chars), bad.select("key", "keep"), ["key"], hot, F.struct("file", "row", "pos"))
    lost = met.filter(~F.col("doc").eqNullSafe(F.col("keep"))).groupBy("file", "row").agg(F.collect_list("pos").alias("lost"))
    at = docs.metadataColumn("_metadata")
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], F.xxhash64(at.getField("file_path")).alias("file"), at.getField("row_index").alias("row"))
    rows = texts.join(lost, ["file", "row"], "left").withColumn("line", _lines(F.col("text"))).withColumn("n_lines", F.size("line").cast("long"))
    stays = F.array_except(F.sequence(F.lit(0), (F.col("n_lines") - 1).cast("int")), F.col("lost"))
    kept = F.when(F.col("lost").isNull(), F.coalesce(F.col("text").cast("string"), F.lit(""))).otherwise(F.array_join(F.transform(stays, lambda i: F.col("line")[i]), "\n"))
    return rows.select("doc_id", "n_lines", F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("text"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(shared.read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP11_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
b AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT k.*, coalesce(keep <> doc_id, FALSE) AS gone FROM k LEFT JOIN b USING (key))
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM f GROUP BY doc_id
"""
