from __future__ import annotations

import re

import pytest

from ledgerloom.llm import near_dedup


def brute(rows, percent):
    """Smallest id of each document's group, from all pairs that share a shingle."""
    sets, at = {}, {}
    for doc_id, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(text, "utf8").lower())
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        for s in sets[doc_id]:
            at.setdefault(s, []).append(doc_id)
    least = {i: i for i in sets}
    for a, b in {(min(a, b), max(a, b)) for own in at.values() for k, a in enumerate(own) for b in own[k + 1 :]}:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and least[a] != least[b]:
            lo, hi = sorted((least[a], least[b]))
            least = {i: lo if x == hi else x for i, x in least.items()}
    return least


def test_pairs_between_80_and_85(table):
    rows = []
    for i in range(400):  # 104 shingles each; ten changed at the end of the second: 94 of 114 are shared (0.825)
        words = [f"w{i}_{k}" for k in range(108)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:98] + [f"x{k}_{i}" for k in range(10)]))]
    docs = table(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 80).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(docs, 79)


def test_equals_brute_force_at_80(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, 80)
    assert want != brute(rows, 85)
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 80).collect()} == want
