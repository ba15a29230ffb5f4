from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from ledgerloom.llm import language


def test_codewords_are_apart():
    for n in (1, 2, 4, 9):
        code = language.codewords(n)
        assert code.shape[0] == n and set(np.unique(code)) <= {-1, 1}
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart, default=3) >= 3


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.op8_language_id(spark, sf.replace("0.001", "0.01")).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97


def test_edges(table):
    rows = [(i, t, v, 0.5) for i, (t, v) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    rows += [(100, None, "en", 1.0), (101, "", None, 1.0), (102, "12 !? 34", "de", 1.0), (None, "der hund", "de", 1.0), (103, "und die katze " * 5000, None, None)]
    docs = table(rows, "doc_id long, text string, lang string, score double")
    model = language.fit(docs)
    got = {r.row.doc_id: (r.lang_pred, r.score, r.ambiguous) for r in language.identify(docs, model).collect()}
    assert [got[i] for i in (100, 101, 102)] == [("und", 0.0, True)] * 3
    assert got[103][0] == got[None][0] == "de" and got[0][0] == "en"
    kept = language.known_language(docs, model)
    assert kept.columns == docs.columns and {100, 101, 102}.isdisjoint(r.doc_id for r in kept.collect())
    none = language.fit(docs.filter("lang IS NULL"))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0
    assert none(pa.array(["x"]))[0] == ["und"]


def test_mixed_texts_are_ambiguous_and_clean_ones_not():
    import pyarrow.parquet as pq

    rows = pq.read_table("/root/testdata/sf0.1/documents.parquet").to_pylist()
    learnt = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] and r["text"]][:2400]
    model = language.train(language.trigrams(pa.array([r["text"] for r in learnt])), [r["lang"] for r in learnt])
    away = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["lang"] and r["text"]]
    assert model(pa.array([r["text"] for r in away]))[2].mean() <= 0.01
    by, rng, mixed = {}, np.random.default_rng(0), []
    for r in away:
        by.setdefault(r["lang"], []).append(r["text"].split()[:80])
    for _ in range(600):
        a, b = rng.choice(sorted(by), 2, replace=False)
        u, v = (by[x][rng.integers(len(by[x]))] for x in (a, b))
        n = min(len(u), len(v))
        if n > 5:
            mixed.append(" ".join(u[:n] + v[:n]))
    assert len(mixed) > 500 and model(pa.array(mixed))[2].mean() >= 0.85


def test_scores_equal_a_plain_computation():
    rng = np.random.default_rng(1)
    words = {"a": ["alba", "bora", "cala"], "b": ["wirt", "zehn", "quer"], "c": ["ushi", "pike", "dome"]}
    texts = [(v, " ".join(rng.choice(words[v], 12))) for v in words for _ in range(20)]
    model = language.train(language.trigrams(pa.array([t for _, t in texts])), [v for v, _ in texts])
    asked = ["alba bora quer zehn", "pike dome", "cala", "xx"]
    told = model(pa.array(asked))
    for i, text in enumerate(asked):
        raw, counts = text.encode(), [0] * language.BUCKETS
        for k in range(len(raw) - 2):
            at = ((raw[k] << 16 | raw[k + 1] << 8 | raw[k + 2]) * 0x9E3779B1 & 0xFFFFFFFF) >> 21
            counts[at] += 1
        total = sum(counts)
        x = [(n / total) ** 0.5 if total else 0.0 for n in counts]
        margin = [sum(a * float(w) for a, w in zip(x, model.weights[:-1, k], strict=True)) + float(model.weights[-1, k]) for k in range(model.code.shape[1])]
        loss = [sum(float(t) * np.exp(-min(5, max(-5, float(c) * m))) for t, c, m in zip(model.trust, word, margin, strict=True)) for word in model.code]
        assert told[0][i] == model.languages[int(np.argmin(loss))]
        assert abs(told[1][i] - 1 / sum(np.exp(-4 * (v - min(loss))) for v in loss)) < 1e-4
