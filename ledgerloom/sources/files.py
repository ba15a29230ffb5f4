"""Readers of file sets: a table's spec says its columns, separator, glob and provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CDC = "cdc_flag string, cdc_dsn long"


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: str
    glob: str
    sep: str = "|"
    header: bool = False
    batches: tuple[int, ...] = (1,)
    #: Batches whose files start with the two change columns.
    cdc_from: int | None = None


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: str, sep: str = "|", glob: str | None = None, header: bool = False, strict: bool = False) -> DataFrame:
    """No inference: the schema is given; ``strict`` fails the job on a line that doesn't fit."""
    r = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return (r.option("pathGlobFilter", glob) if glob else r).csv(path)


def batch_of_path() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"/Batch(\d+)", 1).cast("int")


def read_table(spark: SparkSession, spec: TableSpec, root: str, fmt: str = "csv", strict: bool = False) -> DataFrame:
    """All batches of a table with their number as ``batchid``; change columns are dropped and batches without them aligned."""
    frames = []
    for cdc in (False, True):
        own = [b for b in spec.batches if (spec.cdc_from is not None and b >= spec.cdc_from) == cdc]
        if not own:
            continue
        paths = [f"{root}/Batch{b}" for b in own]
        if fmt == "csv":
            df = read_delimited(spark, paths, f"{CDC}, {spec.schema}" if cdc else spec.schema, spec.sep, spec.glob, spec.header, strict)
        else:
            df = spark.read.schema(f"{CDC}, {spec.schema}" if cdc else spec.schema).option("pathGlobFilter", spec.glob).format(fmt).load(paths)
        df = df.select("*", batch_of_path().alias("batchid"))
        frames.append(df.drop("cdc_flag", "cdc_dsn") if cdc else df)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_all(spark: SparkSession, specs: Sequence[TableSpec], root: str, fmt: str = "csv") -> dict[str, DataFrame]:
    return {s.name: read_table(spark, s, root, fmt) for s in specs}


def stream_table(spark: SparkSession, schema: str, path: str, fmt: str = "csv", sep: str = "|", glob: str | None = None, files_per_trigger: int = 1) -> DataFrame:
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt)
    r = r.option("sep", sep) if fmt == "csv" else r
    return (r.option("pathGlobFilter", glob) if glob else r).load(path)


Field = tuple[str, int, int, str]


def parse_fixed_width(df: DataFrame, fields: Sequence[Field], on: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Fields (name, start from 1, length, type) of a text column, trimmed; what can't be read becomes null."""
    from ledgerloom.functions.clean import tolerant

    cols = []
    for name, start, length, kind in fields:
        text = F.trim(F.substring(F.col(on), start, length))
        cols.append((F.nullif(text, F.lit("")) if kind == "string" else tolerant(text, kind)).alias(name))
    return df.select(*keep, *cols)


def split_record_types(df: DataFrame, on: str = "value") -> DataFrame:
    """Fixed-width lines: the day they were filed, the type of record, and the rest.

    Records of type FIN name their company by number or by name in the last 60 characters;
    those that are numbers become type FIN_COMPANYID, the others FIN_NAME.
    """
    v = F.col(on)
    kind = F.substring(v, 16, 3)
    ref = F.trim(F.substring(v, 187, 60))
    typed = F.when(kind == "FIN", F.when(ref.try_cast("long").isNotNull(), "FIN_COMPANYID").otherwise("FIN_NAME")).otherwise(kind)
    return df.select(F.try_to_timestamp(F.substring(v, 1, 8), F.lit("yyyyMMdd")).cast("date").alias("pts"), typed.alias("rectype"), F.substring(v, 19, 10_000).alias("value"))


def fixed_width(fields: Sequence[tuple[str, int]]) -> Column:
    """One text line: each column padded (or cut) to its width, null as blanks."""
    return F.concat(*[F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("")), n, " ") for c, n in fields])


def write_fixed_width(df: DataFrame, path: str, fields: Sequence[tuple[str, int]]) -> None:
    df.select(fixed_width(fields).alias("value")).write.mode("overwrite").text(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str) -> None:
    df.write.mode("overwrite").format("xml").option("rootTag", root_tag).option("rowTag", row_tag).save(path)


def flatten(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Columns by paths into nested structs; empty texts become null."""
    out = df.select(*[F.col(path).alias(name) for name, path in mapping.items()])
    from ledgerloom.functions.clean import blank_to_null

    return blank_to_null(out)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("dataset string, batchid int, date date, attribute string, value long, dvalue decimal(15,5)").option("header", True).csv(path)
