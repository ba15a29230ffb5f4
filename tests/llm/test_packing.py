from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import packing


def ids_of(text):
    of = Tokenizer.from_file(packing.vocabulary())
    return np.array([*of.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é́Σς'sİ.\x1c\xa0!<|endoftx>1½ǰJ̌ﬁ\n"), max_size=40))
def test_tokens_equal_the_tokenizer(text):
    own = test_tokens_equal_the_tokenizer.__dict__.setdefault("own", packing.Tokens(packing.vocabulary()))
    assert own(text) == ids_of(text)[:-1].tobytes()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 30), max_size=12))
def test_plan_fills_every_slot_once(counts):
    used = defaultdict(list)
    seen = defaultdict(int)
    for length, lo, hi, first, per, base in packing.best_fit(counts, 20):
        assert lo == seen[length]
        seen[length] = hi
        for q in range(lo, hi):
            used[first + (q - lo) // per].append((base + (q - lo) % per * length, length))
    assert dict(seen) == counts
    for slots in used.values():
        to = 0
        for offset, length in sorted(slots):
            assert offset == to
            to += length
        assert to <= 20
    assert sorted(used) == list(range(len(used)))


def check(docs, rows, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for slots in by_seq.values():
        to = 0
        for offset, length in sorted(slots):
            assert offset == to
            to += length
        assert to <= capacity
    for doc_id, text in docs:
        ids = ids_of(text)
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // capacity)))
        for r in own:
            part = ids[r.piece * capacity : (r.piece + 1) * capacity]
            assert (r.start, r.length, r.ids_crc32) == (r.piece * capacity, len(part), zlib.crc32(part.tobytes()))
    total = sum(r.length for r in rows)
    assert len(by_seq) >= -(-total // capacity)
    return len(by_seq), -(-total // capacity)


def test_pack_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs, packing.vocabulary()).collect()
    n, least = check([(r.doc_id, r.text) for r in docs.collect()], rows, packing.CAPACITY)
    assert n <= least + 1


def test_pack_edges(table):
    rows = [(1, None, 9), (2, "", 9), (3, "one two three " * 40, None), (4, "same text", 1), (5, "same text", 1), (6, "x", 2)]
    docs = table(rows, "doc_id long, text string, length int")
    found = packing.pack(docs, packing.vocabulary(), capacity=16, keep_ids=True).collect()
    check([r[:2] for r in rows], found, 16)
    assert all(len(r.ids) == r.length for r in found)
    assert packing.pack(docs.limit(0), packing.vocabulary()).count() == 0
    again = packing.pack(docs.selectExpr("CAST(NULL AS long) doc_id", "text").union(docs.select("doc_id", "text")).union(docs.select("doc_id", "text")), packing.vocabulary(), 16).collect()
    assert len(again) == 3 * len(found)


def test_tokenizers_that_cut_otherwise(table):
    from tokenizers import Tokenizer

    path = packing.vocabulary("byte_bpe_50k.json")
    texts = ["The Cat  sat.\nIt's  late", "", "naïve Ünder 12 34 <|endoftext|> x", "word " * 300]
    rows = packing.pieces(table([*enumerate(texts)], "doc_id long, text string"), path, keep_ids=True).collect()
    plain = Tokenizer.from_file(path)
    assert {r.doc_id: [*r.ids] for r in rows} == {i: [*plain.encode(t, add_special_tokens=False).ids, packing.END_ID] for i, t in enumerate(texts)}


def test_repeated_rows_and_long_texts(table):
    rows = [(7, "same text again")] * 1500 + [(None, "no id")] * 30 + [(8, "long words here " * 40_000)]
    docs = table(rows, "doc_id long, text string")
    got = packing.pack(docs, packing.vocabulary()).collect()
    assert sum(r.doc_id == 7 for r in got) == 1500 and sum(r.doc_id is None for r in got) == 30
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    end = {}
    for seq, offset, length in places:
        assert offset == end.get(seq, 0)
        end[seq] = offset + length
    assert max(end.values()) <= 4096 and len(end) == -(-sum(end.values()) // 4096)
