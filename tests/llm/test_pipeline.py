from __future__ import annotations

import re
from collections import defaultdict

import corpus_pipeline

from tests.llm import test_near_dedup_threshold, test_packing


def test_stages_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept, names = docs.columns, {r.doc_id: r.text for r in docs.collect()}, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.shared.materialize(stage(spark, docs, sf), name)
        assert docs.columns == columns
        got = {r.doc_id: r.text for r in docs.collect()}
        if name == "language_id":
            gone = kept.keys() - got.keys()
            assert len(gone) <= 2 and all(got[i] == kept[i] for i in got)
        elif name == "exact_dedup":
            first = {}
            for i in sorted(kept):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[i]), i)
            assert got.keys() == {*first.values()}
        elif name == "near_dedup":
            assert got.keys() == {i for i, least in test_near_dedup_threshold.brute([*kept.items()], 80).items() if i == least}
        else:
            words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
            windows = defaultdict(set)
            for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
                w = words(r.text)
                n = min(10, len(w))
                windows[n].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n)
            hit = {i for i, t in kept.items() for w in [words(t)] for n, p in windows.items() if any(tuple(w[k : k + n]) in p for k in range(len(w) - n + 1))}
            assert got.keys() == kept.keys() - hit and hit
        kept = got
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    test_packing.check([*kept.items()], rows, 4096)
    assert len(rows) == len(corpus_pipeline.run(spark, sf).collect())


def test_edges(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and ids, columns with names that stages use themselves, an empty table."""
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120)
    long = real.filter("length(text) BETWEEN 500 AND 2000").orderBy("doc_id").first()
    odd = [
        (None, None, None, None, None), (90_001, None, "en", None, None), (90_002, "", None, "s", 0), (90_003, " \t\n", "xx", None, 3), (None, long.text, None, None, None), (90_004, long.text * 300, long.lang, "s", None),
        (90_005, long.text, None, "s", 1), (90_005, long.text, None, "s", 1), (90_005, "12345 67890 " * 50, None, None, 2),
    ]
    docs = real.union(spark.createDataFrame(odd, real.schema)).selectExpr("*", "'c' AS kept", "1L AS component_id", "2 AS norm", "3 AS piece", "map('a', 1) AS digest")
    docs = corpus_pipeline.shared.materialize(docs.coalesce(1), "documents")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.shared.materialize(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert kept.columns == columns
        if name == "language_id":
            assert {r.doc_id for r in kept.filter("text IS NULL OR trim(text) = ''").collect()} == set()
        if name == "exact_dedup":
            assert kept.filter(kept.text == long.text).count() == 1
        docs = kept
    assert 0 < docs.count() < n
    packed = corpus_pipeline.packed(spark, docs, "/root/testdata/sf0.001").collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, corpus_pipeline.shared.materialize(empty, name), "/root/testdata/sf0.001").count() == 0
