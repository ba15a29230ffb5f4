"""Buckets of more members than are compared at once: parted by further coordinates, or block by block."""

from __future__ import annotations

import random

import pytest

from ledgerloom.llm import near_dedup
from tests.llm.test_near_dedup_threshold import brute


def crowd(rng, n, edits):
    """Texts of a common stock, each with runs of words of its own, so that one bucket holds many that are near to some only."""
    stock = [f"s{k}" for k in range(120)]
    out = []
    for i in range(n):
        words = list(stock)
        for _ in range(edits):
            at = rng.randrange(len(words))
            words[at : at + 1] = [f"x{i // 3}_{rng.randrange(4)}"]
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize(("percent", "edits"), [(85, 2), (80, 3)])
@pytest.mark.parametrize("levels", [0, near_dedup.LEVELS])
def test_large_buckets_lose_no_link(table, monkeypatch, percent, edits, levels):
    rng = random.Random(percent)
    rows = crowd(rng, 240, edits) + [(1000, "one two three four five " * 3000), (1001, "one two three four five " * 3000)]
    want = brute(rows, percent)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(rows, "doc_id long, text string"), percent, levels).collect()}
    assert got == want and 3 < len({*want.values()}) < len(rows)
