from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import language


def test_the_driver_gets_packed_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = language.examples(docs).collect()
    text = {str(r.doc_id): r.text for r in docs.collect()}
    x = language.unpacked([r.x for r in rows])
    assert len(rows) > 20 and np.array_equal(x, language.trigrams(pa.array([text[r.doc_id] for r in rows])))
    assert sum(len(r.x) for r in rows) < x.nbytes / 3
    assert language.examples(docs.withColumn("lang", F.lit(None).cast("string"))) is None


def test_training_takes_no_wide_copies_of_its_rows():
    x = np.random.default_rng(1).random((6000, language.BUCKETS), np.float32)
    languages = ["en" if v else "de" for v in x[:, 0] > 0.5]
    tracemalloc.start()
    try:
        model = language.train(x, languages)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 8 * x.size + 8 * language.BUCKETS**2  # less than one copy in 64 bits, and the sums
    assert np.mean([model.languages[k] == v for k, v in zip(model.losses(x).argmin(1), languages, strict=True)]) > 0.9


def test_blocks_of_rows_give_the_whole_solution(monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.random((70, 12), np.float32)
    languages = [["de", "en", "fr"][k] for k in rng.integers(0, 3, 70)]
    whole = language.Model.fit(x, languages)
    monkeypatch.setattr(language, "FITTED_TOGETHER", 16)
    parts = language.Model.fit(x, languages)
    own, bits = np.hstack([x, np.ones((70, 1))]).astype(float), whole.code[[whole.languages.index(v) for v in languages]]
    each = np.array([70 / 3 / languages.count(v) for v in languages])[:, None]
    w = np.linalg.solve(own.T @ (own * each) + 0.02 * np.eye(13), own.T @ (bits * each))
    for model in (whole, parts):
        assert np.allclose(model.weights, w, atol=1e-5) and np.allclose(model.trust, whole.trust)
