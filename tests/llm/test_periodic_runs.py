from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import periodic_runs as P
from ledgerloom.llm import shared


def brute(words, min_length=6, min_exponent=4):
    """For every period the longest stretches that keep it, whose own smallest period it is."""
    n, found = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(min_length, min_exponent * q) and not any(all(words[x] == words[x + r] for x in range(s, s + length - r)) for r in range(1, q)):
                found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_random_texts_in_batches():
    rng = random.Random(5)
    for _ in range(60):
        texts = []
        for _ in range(rng.randrange(1, 12)):
            words = [rng.choice([b"a", b"b", b"c"][: rng.randrange(1, 4)]) for _ in range(rng.randrange(0, 40))]
            for _ in range(rng.randrange(0, 3)):
                at, p = rng.randrange(len(words) + 1), [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randrange(1, 9))]
                words[at:at] = (p * 9)[: rng.randrange(1, 60)]
            texts.append(words)
        for least, exponent in ((6, 4), (2, 2), (5, 3)):
            assert P.runs_of(texts, least, exponent) == [brute(w, least, exponent) for w in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"x", b"y"]), max_size=60), max_size=4))
def test_two_words(texts):
    found = P.runs_of(texts)
    assert found == [brute(w) for w in texts]
    assert [P.collapsed(w, r) for w, r in zip(texts, found, strict=True)] == [brute_collapsed(w, r) for w, r in zip(texts, found, strict=True)]


def test_very_long_runs():
    assert P.runs_of([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    words = [str(i % 50_000).encode() for i in range(220_000)]
    assert P.runs_of([words]) == [[(0, 220_000, 50_000)]]


def edge_rows():
    return [(1, "a b " * 9), (1, "a b " * 9), (2, None), (3, ""), (4, " \t\n\x0b"), (None, "w " * 7), (None, None), (5, "no run in here at all"), (6, "é\x1cé é\x1cé\xa0x " * 8), (7, "A a " * 6), (8, "x " * 50_000), (9, "a a a a a"), (10, "a a a a a a")]


def test_edges(table):
    docs = table([(d, t, 1, "c") for d, t in edge_rows()], "doc_id long, text string, runs int, start string")
    found = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.text) for r in P.periodic_runs(docs).collect()), key=str)
    want = []
    for d, t in edge_rows():
        words = (t or "").encode().split()
        runs = brute(words) if len(words) < 1000 else [(0, len(words), 1)]
        want.append((d, runs, b" ".join(brute_collapsed(words, runs)).decode()))
    assert found == sorted(want, key=str)
    assert P.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.periodic_runs(docs, 6, 1)


def contract(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(listed.encode()), sha(b" ".join(brute_collapsed(words, runs))))


def test_whole_table(spark, sf):
    found = sorted(tuple(r) for r in P.op13_periodic_runs(spark, sf).collect())
    assert found == sorted(contract(r.doc_id, r.text) for r in shared.read(spark, sf, "documents").select("doc_id", "text").collect())
    assert sum(r[1] for r in found) > 5
