"""Large groups of near copies of one text that aren't all linked: rows in proportion to the members, and no link lost."""

from __future__ import annotations

import random

import pytest

from ledgerloom.llm import near_dedup
from tests.llm.test_near_dedup_threshold import brute


@pytest.mark.parametrize("block", [16, near_dedup.BLOCK])
def test_rows_grow_with_members(table, monkeypatch, block):
    rng, rows = random.Random(1), []
    for i in range(400):  # each with up to five words of its own
        words = [f"w{k}" for k in range(150)]
        for k in rng.sample(range(150), i % 6):
            words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    made, write = {}, near_dedup.shared.materialize

    def counted(df, name):
        out = write(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    docs = table(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup.shared, "materialize", counted)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 80).collect()}
    assert got == brute(rows, 80) and len({*got.values()}) > 50
    assert max(made.values()) <= 40 * len(rows), made


def drifting(rng, n):
    """Variants of one text, by edits from few words, and variants of these, so that links often bypass the first text."""
    texts = [[f"w{k}" for k in range(120)]]
    while len(texts) < n:
        words = list(texts[rng.randrange(len(texts)) if rng.random() < 0.3 else 0])
        for _ in range(rng.randrange(1, 6)):
            at, kind = rng.randrange(len(words) - 1), rng.randrange(4)
            words[at : at + kind % 3] = [] if kind == 1 else [rng.choice("abc") * rng.randrange(1, 4)]
        texts.append(words)
    order = [*range(n)]
    rng.shuffle(order)
    return [(order[i], " ".join(x)) for i, x in enumerate(texts)]


@pytest.mark.parametrize("percent", [80, 85, 92])
def test_parts_lose_no_link(table, monkeypatch, percent):
    rows, called, parted = drifting(random.Random(percent), 300), [], near_dedup._parted
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    monkeypatch.setattr(near_dedup, "_parted", lambda *a: called.append(parted(*a)) or called[-1])
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(rows, "doc_id long, text string"), percent).collect()}
    assert got == brute(rows, percent) and called[0].count() > 0
    assert 1 < len({*got.values()}) < len(rows)


def test_parts_of_ids_that_repeat(table, monkeypatch):
    rows = drifting(random.Random(7), 200)
    want, far = brute(rows, 80), [(i, f"far{i} " + " ".join(f"y{i}_{k}" for k in range(60))) for i in range(0, 200, 3)]
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(rows + far, "doc_id long, text string"), 80).collect()}
    assert got == want
