from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def table(spark, tmp_path):
    """Writes rows as a Parquet table and reads it back, as operators meet their inputs."""

    def make(rows, schema, name="documents"):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make
