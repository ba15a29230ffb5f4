from __future__ import annotations

import random

import pytest

from ledgerloom.llm import decontaminate


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = (text or "").split()
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(None if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, ids = (text or "").split(), set(), set()
        for p, own in windows.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    ids |= own
        out.append((doc, len(w), len(hit), sorted(ids, key=lambda i: (i is None, str(i))), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 22, 200])
def test_equals_brute_force(spark, table, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 9, 10, 11, 25])))) for i in range(12)]
    items = [(i, t) for i, t in items if len(t.split()) != 1] + [(50, None), (None, "w1 w2 w3"), (51, "solo"), (3, "w0 w1 w2 w3 w4 w5 w0 w1 w2 w3 w4")]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    docs += [(100 + i, f"x y {t} z {t}") for i, t in items[:8] if t] + [(200, None), (None, "solo a"), (7, "dup solo"), (300, "pad " * 50_000 + items[-1][1])]
    df = table([(*r, "x") for r in docs], "doc_id long, text string, spans string")
    bench = table(items, "item_id long, text string", "benchmark")
    rows = decontaminate.decontaminate(df, bench).collect()
    assert sorted([(r.doc.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows], key=str) == brute(docs, items)
    clean = decontaminate.drop_contaminated(df, bench)
    assert clean.columns == df.columns and clean.count() == sum(not r[4] for r in brute(docs, items))
    assert decontaminate.decontaminate(df.limit(0), bench).count() == 0
    none = decontaminate.decontaminate(df, bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)


def test_tables_are_small():
    import tracemalloc

    import pyarrow as pa

    rng, said, size = random.Random(0), [], 0
    while size < 1 << 20:
        said.append(" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(120)).encode())
        size += len(said[-1])
    tracemalloc.start()
    made = decontaminate.Matcher(pa.array(map(str, range(len(said)))), pa.array(said, pa.binary()))
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 14 * size + (4 << 20) and peak < 26 * size + (4 << 20)
    assert made(pa.array([said[5].decode() + " x y", "nothing"]))[2] == [["5"], []]


def test_long_items_lose_no_window(table, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 16)
    words = [f"w{i}" for i in range(200)]
    bench = table([(1, " ".join(words)), (2, "")], "item_id long, text string", "benchmark")
    docs = [(i, " ".join(["a", *words[i : i + 10], "b"])) for i in range(191)] + [(500, " ".join(words[3:12]))]
    rows = decontaminate.decontaminate(table(docs, "doc_id long, text string"), bench).collect()
    assert {r.doc.doc_id: (r.n_hit, r["items"]) for r in rows} == {i: (10, ["1"]) for i in range(191)} | {500: (0, [])}
