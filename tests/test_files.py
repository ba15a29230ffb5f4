from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import clean as C
from ledgerloom.operators import audit as A
from ledgerloom.operators import matching as M
from ledgerloom.sources import files, tables
from ledgerloom.streaming import replay


def test_fixed_width_and_record_types(spark):
    line = "20200131-120000FIN" + "2019" + "4" + "20191001" + "20200131" + "12.5".rjust(17) + " " * 130 + "0000000042".ljust(60)
    named = line[:186] + "Acme Corp".ljust(60)
    bad = "2020x131-120000CMP" + "Acme".ljust(60)
    df = spark.createDataFrame([(line,), (named,), (bad,)], "value string")
    split = files.split_record_types(df)
    assert [(str(r.pts), r.rectype) for r in split.collect()] == [("2020-01-31", "FIN_COMPANYID"), ("2020-01-31", "FIN_NAME"), ("None", "CMP")]
    fields = [("year", 1, 4, "int"), ("qtr", 5, 1, "int"), ("start", 6, 8, "date"), ("rev", 22, 17, "double"), ("ref", 169, 60, "string")]
    r = files.parse_fixed_width(split.filter("rectype LIKE 'FIN%'"), fields, keep=["rectype"]).orderBy("rectype").collect()
    assert tuple(r[0]) == ("FIN_COMPANYID", 2019, 4, dt.date(2019, 10, 1), 12.5, "0000000042") and r[1].ref == "Acme Corp"


def test_batches_align_and_strict_mode_fails(spark, tmp_path):
    for b, lines in ((1, ["1|a", "2|"]), (2, ["I|9|3|c"]), (3, ["U|10|1|z"])):
        (tmp_path / f"Batch{b}").mkdir()
        (tmp_path / f"Batch{b}" / "T.txt").write_text("\n".join(lines) + "\n")
    spec = files.TableSpec("t", "k int, v string", "T*.txt", batches=(1, 2, 3), cdc_from=2)
    got = sorted(tuple(r) for r in files.read_table(spark, spec, f"file://{tmp_path}").fillna("").collect())
    assert got == [(1, "a", 1), (1, "z", 3), (2, "", 1), (3, "c", 2)]
    (tmp_path / "bad.txt").write_text("x|y\n")
    with pytest.raises(Exception, match="(?i)malformed|cast|parse"):
        files.read_delimited(spark, f"file://{tmp_path}/bad.txt", "k int, v string", strict=True).collect()


def test_layouts(spark, tmp_path):
    home = f"file://{tmp_path}"
    df = spark.range(20).select("id", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("d"))
    tables.replace_keys(df, f"{home}/k", "d")
    tables.replace_where(df.filter("id = 0"), f"{home}/k", "d", F.lit("2020-01-01").cast("date"))
    assert spark.read.parquet(f"{home}/k").count() == 16
    with pytest.raises(Exception, match="rows outside"):
        tables.replace_where(df, f"{home}/k", "d", F.lit("2020-01-01").cast("date"))
    tables.write_by_date(df, f"{home}/by", "d")
    assert spark.read.parquet(f"{home}/by").filter("d = _pdate").count() == 20
    tables.sized(df.coalesce(1), f"{home}/s", 100, 500)
    assert len([*(tmp_path / "s").glob("part-*")]) == 4
    tables.write_snapshot(df, f"{home}/v", 1)
    tables.write_snapshot(df.limit(3), f"{home}/v", 1)
    assert tables.read_snapshot(spark, f"{home}/v", 1).count() == 3
    old, new = tables.split_at(df, "d", F.lit("2020-01-03").cast("date"))
    assert (old.count(), new.count()) == (10, 10)
    tables.clustered(df, f"{home}/c", "id", 3)
    assert tables.recode(spark, df, f"{home}/r", 2).count() == 20
    parts = replay.DailyParts(spark, f"{home}/seed", "d")
    replay.seeded(df, parts)
    replay.seeded(df.limit(1), parts)
    assert parts.read(df.schema).count() == 20


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    home = f"file://{tmp_path}/fold"
    feed = f"{home}/feed"
    for i in range(3):
        spark.createDataFrame([(1, i), (2, 10 * i)], "k long, v long").coalesce(1).write.mode("append").parquet(feed)
    step = lambda held, b: held.unionByName(b).groupBy("k").agg(F.sum("v").alias("v"))
    seed = spark.createDataFrame([], "k long, v long")
    stream = lambda: files.stream_table(spark, "k long, v long", feed, "parquet")
    assert {tuple(r) for r in replay.fold(stream(), seed, step, home).collect()} == {(1, 3), (2, 30)}
    # the last batch's commit is lost: it runs again from the version before and gives the same
    last = max((tmp_path / "fold/checkpoint/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    crc = last.with_name(f".{last.name}.crc")
    crc.unlink(missing_ok=True)
    assert {tuple(r) for r in replay.fold(stream(), seed, step, home).collect()} == {(1, 3), (2, 30)}
    spark.createDataFrame([(1, 5)], "k long, v long").write.mode("append").parquet(feed)
    assert {tuple(r) for r in replay.fold(stream(), seed, step, home).collect()} == {(1, 8), (2, 30)}


def test_cleaning(spark):
    df = spark.createDataFrame([("1", "555", "1234567", "9"), ("", "", "7654321", None), ("1", "2", "", "3"), (None, None, None, None)], "a string, b string, c string, d string")
    assert [r.p for r in df.select(C.phone("a", "b", "c", "d").alias("p")).collect()] == ["+1 (555) 12345679", "7654321", None, None]
    codes = spark.createDataFrame([("ACTV", "AAA"), ("XX", "CC-"), (None, None), ("", "B")], "s string, r string")
    got = codes.select(C.map_codes("s", C.STATUS).alias("m"), C.map_codes("s", C.STATUS, True).alias("p"), C.low_grade("r").alias("g"), C.id_or_name(F.concat(F.lit("00"), F.lit("12"))).alias("i")).collect()
    assert [tuple(r) for r in got] == [("Active", "Active", False, "12"), (None, "XX", None, "12"), (None, None, None, "12"), (None, "", True, "12")]
    key = spark.sql("SELECT DATE'2020-02-03' AS d, 17 AS k").select(C.version_key("d", "k").alias("v")).first().v
    assert key == 2020020317 and spark.range(1).select(C.natural_key(F.lit(key))).first()[0] == 17
    assert C.blank_to_null(df).filter("b IS NULL").count() == 2


def test_matching(spark):
    a = spark.sql("SELECT * FROM VALUES (1, 'Ann', ''), (2, 'BOB', NULL), (3, NULL, 'x') AS t(id, n, l)")
    b = spark.sql("SELECT * FROM VALUES ('ann', NULL), ('ANN', ''), ('bob', 'y') AS t(n, l)")
    assert {(r.id, r.matched) for r in M.identity_match(a, b, ["n"], ["l"]).collect()} == {(1, True), (2, False), (3, False)}
    assert a.join(b, M.identity_condition(a, b, ["n"], ["l"])).count() == 2
    with pytest.raises(ValueError):
        M.affine_index(F.col("id"), 10, 4, 1)
    with pytest.raises(ValueError):
        M.affine_index(F.col("id"), 5_000_000_000, 3, 1)
    n = spark.range(1000).select(M.affine_index(F.col("id"), 1000, 7, 3).alias("i"), M.from_dictionary(F.col("id"), ["a", "b"]).alias("v"))
    assert n.select("i").distinct().count() == 1000 and n.select("v").distinct().count() == 2


def test_expectations_and_counts(spark):
    df = spark.sql("SELECT * FROM VALUES (1), (5), (NULL) AS t(x)")
    assert [tuple(r) for r in A.expect(df, {"small": F.col("x") < 3}).collect()] == [("small", 1, 1, 1)]
    dim = spark.sql("SELECT * FROM VALUES (1, DATE'2020-01-01', DATE'2020-01-05', false), (1, DATE'2020-01-03', DATE'9999-12-31', true), (2, DATE'2020-01-03', DATE'2020-01-03', true) AS t(k, effectivedate, enddate, iscurrent)")
    assert {r.test.split(" ", 1)[1]: r.failures for r in A.check_scd2("d", dim, ["k"]).collect()} == {"aligned": 1, "overlap": 1, "end of time": 1, "empty version": 1, "iscurrent": 1}


def test_fold_rewrites_touched_buckets_only(spark, tmp_path):
    home, feed = f"file://{tmp_path}/target", f"file://{tmp_path}/feed"
    seed = spark.range(40).selectExpr("id AS k", "0L AS v")
    step = lambda held, b: held.unionByName(b).groupBy("k").agg(F.sum("v").alias("v"))
    for i in range(4):
        spark.createDataFrame([(1, i), (2, 10)], "k long, v long").coalesce(1).write.mode("append").parquet(feed)
    got = replay.fold(files.stream_table(spark, "k long, v long", feed, "parquet"), seed, step, home, ["k"])
    assert {tuple(r) for r in got.collect()} == {(1, 6), (2, 40), *((k, 0) for k in (0, *range(3, 40)))}
    versions: dict[str, list[str]] = {}
    for v in sorted((tmp_path / "target" / "table").glob("version_=*")):
        for b in v.glob("bucket_=*"):
            versions.setdefault(b.name, []).append(v.name)
    changed = [v for v in versions.values() if v != ["version_=-1"]]
    assert 1 <= len(changed) <= 2 < len(versions) and all(v == ["version_=2", "version_=3"] for v in changed)


def test_intermediates_need_a_shared_folder_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master, applicationId = "yarn", "y"

    with pytest.raises(RuntimeError):
        tables.scratch_path(Session(), "x")
