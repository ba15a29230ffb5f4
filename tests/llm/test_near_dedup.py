from __future__ import annotations

import re

from ledgerloom.llm import near_dedup


def brute(rows):
    sets = {}
    for doc_id, text in rows:
        low = bytes(text or "", "utf8").lower()
        w = re.findall(rb"[^\x20\x09-\x0D]+", low)
        sets.setdefault(doc_id, set()).update([tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])
    ids = sorted(sets)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    at = {}
    for i in ids:
        for s in sets[i]:
            at.setdefault(s, []).append(i)
    pairs = {(a, b) for own in at.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    for a, b in pairs:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= 85 * (len(sets[a]) + len(sets[b]) - inter):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def as_dict(df):
    rows = df.collect()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(found) == len(rows)
    return found


def test_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    assert as_dict(near_dedup.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_chains_and_hot_group(table):
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(260):  # copies with some words changed, and a chain that drifts away
        own = list(base)
        for k in range(i % 7):
            own[(i * 37 + k * 29) % 150] = f"x{i}_{k}"
        rows.append((1000 - i, " ".join(own), None))
    drift = [f"d{i}" for i in range(120)]
    for i in range(20):
        drift[(i * 31) % 120] = f"new{i}"
        rows.append((2000 + i, " ".join(drift).upper() if i % 2 else " ".join(drift), "x"))
    docs = table(rows, "doc_id long, text string, component_id string")
    assert as_dict(near_dedup.near_duplicates(docs)) == brute([r[:2] for r in rows])


def test_edges(table):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, "É é"), (8, "é É"), (9, "a b c d e"), (10, "A B C\nD E")]
    docs = table(rows, "doc_id long, text string")
    got = as_dict(near_dedup.near_duplicates(docs))
    assert got == brute(rows)
    assert got[5] == (1, 4, False) and got[1] == (0, 1, True) and got[8] == (1, 8, True) and got[10] == (1, 9, False)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
    odd = table([(None, "a b"), (1, "a b"), (1, "a b"), (1, "c d"), (3, "c d")], "doc_id long, text string", "odd")
    rows = sorted(near_dedup.near_duplicates(odd).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, None, True)]
    assert {(r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id} == {(1, 1, True), (3, 1, False)}
    assert sorted(r.doc_id for r in near_dedup.drop_near_copies(docs).collect()) == [1, 2, 3, 4, 6, 7, 8, 9]
