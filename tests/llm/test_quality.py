from __future__ import annotations

import zlib

from ledgerloom.llm import quality


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = quality.op3_quality_classifier(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.93


def test_edges(table):
    good = "The river runs to the sea, and the town sleeps. "
    bad = "BUY!! NOW!! ### "
    docs = table([(i, (bad if i % 3 == 0 else good) * (1 + i % 5), 1.0) for i in range(90)] + [(200, None, 1.0), (201, "", None), (None, good, 0.0), (5, good, 1.0)], "doc_id long, text string, score double")
    labels = table([(i, None if i == 1 else int(i % 3 != 0), 0) for i in range(90)] + [(None, 1, 0), (300, 1, 1)], "doc_id long, quality int, toxic int", "labels")
    model = quality.fit(docs, labels)
    got = [(r.row.doc_id, r.score) for r in quality.score(docs, model).collect()]
    assert len(got) == 94 and all(0 <= s <= 1 for _, s in got)
    assert all((s >= 0.7) == (i % 3 != 0) for i, s in got if i is not None and i < 90)
    one = quality.fit(docs, labels.filter("quality = 1"))
    assert {r.score for r in quality.score(docs, one).collect()} == {1.0}
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def plain_features(text):
    """The features of a text, counted one by one."""
    import math
    import statistics

    raw = (text or "").encode()
    kind = {b: i for i, bs in enumerate(quality._KINDS.values()) for b in bs}
    n = max(len(raw), 1)
    x = [sum(kind.get(b) == i for b in raw) / n for i in range(len(quality._KINDS))]
    words = raw.split()
    m = len(words)
    if m:
        low = [w.lower() for w in words]
        threes = [*zip(low, low[1:], low[2:], strict=False)]
        sizes = [len(w) for w in words]
        lead = lambda i: sum(kind.get(w[0], -1) == i for w in words) / m
        tail = lambda i: sum(kind.get(w[-1], -1) == i for w in words) / m
        x += [math.log1p(m), len({*low}) / m, sum(a == b for a, b in zip(low, low[1:], strict=False)) / (m - 1) if m > 1 else 0.0, len({*threes}) / len(threes) if threes else 1.0]
        x += [statistics.fmean(sizes), statistics.pstdev(sizes), min(max(sizes), 60), sizes.count(1) / m, lead(0), lead(1), tail(5), tail(6), tail(7), tail(9), tail(0)]
    else:
        x += [0.0] * 15
    return [*x, *[abs(v) ** 0.5 for v in x], *[min(v, 1) ** 2 for v in x]]


def test_scores_equal_a_plain_computation(spark, sf):
    """Features counted one by one; weights at which the gradient of the plain loss over the same pairs is zero; ranks for the cut."""
    import math

    import numpy as np

    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = sorted((r.doc_id, r.quality) for r in labels.collect() if r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.doc_id in texts)
    x = np.array([plain_features(texts[i]) for i, _ in known])
    y = np.array([q for _, q in known])
    middle, spread = x.mean(0), x.std(0)
    spread[spread < 1e-9] = 1
    z = np.clip((x - middle) / spread, -6, 6)
    model = quality._weights(docs, quality._known(labels))
    good, bad, rng = z[y == 1], z[y == 0], np.random.default_rng(3)
    won = [g for g in range(len(good)) for _ in range(quality.OPPONENTS)] + rng.integers(0, len(good), quality.OPPONENTS * len(bad)).tolist()
    rng = np.random.default_rng(3)
    rng.integers(0, len(good), quality.OPPONENTS * len(bad))
    lost = rng.integers(0, len(bad), quality.OPPONENTS * len(good)).tolist() + [b for b in range(len(bad)) for _ in range(quality.OPPONENTS)]
    d = np.array([good[a] - bad[b] for a, b in zip(won, lost, strict=True)])
    slope = sum(row / (1 + math.exp(row @ model.weights)) for row in d) - 1e-3 * len(d) * model.weights
    assert np.abs(slope).max() < 1e-3 * len(d) ** 0.5
    s = sorted(float(v @ model.weights) for v in z)
    n_bad = int((y == 0).sum())
    cut = (s[n_bad - 1] + s[n_bad]) / 2
    want = {i: 1 / (1 + math.exp(-(float(np.clip((np.array(plain_features(t)) - middle) / spread, -6, 6) @ model.weights) - cut + math.log(0.7 / 0.3)))) for i, t in texts.items()}
    got = {r.doc_id: r.score for r in quality.op3_quality_classifier(spark, sf).collect()}
    assert max(abs(got[i] - want[i]) for i in want) < 1e-6


def test_very_long_texts_ties_and_clashing_columns(table):
    good, bad = "The river runs to the sea, and the town sleeps. ", "BUY!! NOW!! ### "
    rows = [(i, (bad if i % 3 == 0 else good) * 3, 1.0, "r", 7) for i in range(30)] + [(40, good * 60_000, 1.0, "r", 7), (41, "x" * 3_000_000, 0.0, "r", 7)]
    docs = table(rows, "doc_id long, text string, s double, row string, _id int")
    labels = table([(i, int(i % 3 != 0)) for i in range(30)], "doc_id long, quality int", "labels")
    got = {r.row.doc_id: (r.score, r.row.s, r.row.row) for r in quality.fit_and_score(docs, labels).collect()}
    assert len(got) == 32 and got[40][0] >= 0.7 and got[1][0] == got[2][0] and got[5][1:] == (1.0, "r")
    again = {r.row.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert all(abs(again[i] - got[i][0]) < 1e-9 for i in got)
    assert quality.fit_and_score(docs.limit(0), labels).count() == 0
