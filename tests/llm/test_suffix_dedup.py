from __future__ import annotations

import hashlib
import random

from ledgerloom.llm import suffix_dedup


def brute(rows):
    """rows: (doc_id, text) in order of the ids."""
    seen, out = {}, {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            w = raw[i : i + 100]
            if w in seen:
                gone[i : i + 100] = b"\x01" * 100
            else:
                seen[w] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = found(suffix_dedup.op7_suffix_array_dedup(spark, sf))
    assert got == brute(sorted((r.doc_id, r.text) for r in docs.collect()))
    assert sum(r[1] for r in got.values()) > 0


def test_hard_texts(table, monkeypatch):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 9)))
    passage = [" ".join(word() for _ in range(40)) for _ in range(6)]
    rows = [(0, "a" * 350), (1, "ab" * 200 + "a" * 99), (2, None), (3, ""), (4, "x" * 99), (5, "a" * 130)]
    for i in range(6, 120):
        text = [word() for _ in range(rng.randint(0, 60))]
        for p in rng.sample(passage, rng.randint(0, 4)):
            cut = rng.randint(0, 30)
            text += [p[cut:] if rng.random() < 0.5 else p, word(), word()]
        rows.append((i, " ".join(text)))
    rows += [(200, rows[60][1]), (201, rows[61][1][:-1] + "!"), (202, " ".join(passage) * 3)]
    monkeypatch.setattr(suffix_dedup, "SORTED", 2000)
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 5)
    monkeypatch.setattr("ledgerloom.llm.phrases.PART", 3000)
    docs = table([(*r, "x") for r in rows], "doc_id long, text string, n_bytes string")
    assert found(suffix_dedup.remove_repeats(docs)) == brute(rows)
    monkeypatch.setattr(suffix_dedup, "FEW_HOT", 0)
    assert found(suffix_dedup.remove_repeats(docs)) == brute(rows)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_and_null_ids(table):
    text = " ".join(f"word{i}" for i in range(60))
    docs = table([(None, text), (3, text), (3, text), (1, "short")], "doc_id long, text string")
    rows = suffix_dedup.remove_repeats(docs, keep_text=True).collect()
    n = len(text)
    assert sorted((str(r.doc_id), r.n_removed) for r in rows) == [("1", 0), ("3", 0), ("3", n), ("None", n)]
    assert sorted(bytes(r.kept) for r in rows) == [b"", b"", b"short", text.encode()]
