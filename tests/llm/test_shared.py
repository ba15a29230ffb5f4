from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import shared


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, how):
    left = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 500 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"), (F.col("id") % 2).alias("k2"))
    right = left.filter("id % 4 <> 1").groupBy("k", "k2").agg(F.count("*").alias("n"))
    for keys, df in ((["k", "k2"], right), (["k"], right.groupBy("k").agg(F.sum("n").alias("n")))):
        hot = shared.hot_keys(df, keys, "n")
        rows = {tuple(r[k] for k in keys): r["n"] for r in df.collect()}
        assert {tuple(r[k] for k in keys): r["_salts"] for r in hot.collect()} == {k: -(-n // shared.FEW) for k, n in rows.items() if n > shared.FEW}
        cols = ["id", *keys, "n"]
        told = lambda d: sorted(map(str, d.select(*cols).collect()))  # noqa: B023, E731
        rest = left.select("id", *keys)
        assert told(shared.salted_join(rest, df, keys, hot, F.col("id"), how)) == told(rest.join(df, keys, how))
    assert shared.hot_keys(right.limit(0), ["k"], "n") is None


def test_shared_folder_must_be_named_on_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master, applicationId = "spark://host:7077", "x"

    with pytest.raises(RuntimeError):
        shared.shared_dir(Session())
    Session.sparkContext.master = "local[2]"
    assert shared.shared_dir(Session()).startswith("file://")
