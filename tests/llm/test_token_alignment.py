from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerloom.llm import shared
from ledgerloom.llm import token_alignment as T
from ledgerloom.llm.packing import _byte_letters, vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Tokens and links of a text, walked one by one with the libraries' own encoders."""
    a, b, back = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), {c: x for x, c in _byte_letters().items()}
    a.encode_special_tokens = True

    def said(text):
        got = a.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(back[c] for c in t)) for i, t in zip(got.ids, got.tokens, strict=True)]
        right = []
        for i in b.encode(text):
            t = b.id_to_piece(i)
            right.append((i, bytes([int(t[3:5], 16)]) if len(t) == 6 and t.startswith("<0x") else t.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        if any(b"".join(t for _, t in x) != raw for x in (left, right)):
            return None
        spans = []
        for x in (left, right):
            at, out = 0, []
            for i, t in x:
                out.append((i, at, at + len(t)))
                at += len(t)
            spans.append(out)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, at = [], [0, 0]
        for c in cuts:
            sides = []
            for k, x in enumerate(spans):
                first = at[k]
                while at[k] < len(x) and x[at[k]][2] <= c:
                    at[k] += 1
                sides.append(",".join(str(i) for i, _, _ in x[first : at[k]]))
            groups.append("|".join(sides))
        links, j = Counter(), 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links[i, spans[1][k][0]] += 1
                k += 1
        return len(left), len(right), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest(), links

    return said


ODD = ["a ", "  ", " ", "a  b", "a\n b", "\n", "x\n\n y  z\t q ", "a▁b", "<s> </s> <|endoftext|> x", "l'été n’est  pas 123 45", "　全角 文字 ", "a\x1c b", "tab\t tab", "nul\0 x", "﻿bom x", "é é", "x\r\n y", "👩‍👩‍👧 x", "'LL 'll don'T", "​ z", "ſ's", "€" * 40]


def rows_of(texts, plain):
    told = [plain(t) if t else None for _, t in texts]
    held = Counter(p for x in told if x for p in x[4])
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    out = []
    for (d, _), x in zip(texts, told, strict=True):
        if x is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            links = x[4]
            out.append((d, *x[:3], sum(links.values()), sum(n for p, n in links.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in links.items()), x[3]))
    return sorted(out, key=str), held


def told(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


TEXTS = [*enumerate(ODD), (100, None), (101, ""), (None, "a word"), (None, "a word"), (7, "a word"), (7, "another word"), (102, "<|endoftext|>"), *((200 + i, "a word of many") for i in range(20))]


def test_edges(table, plain, monkeypatch):
    docs = table([(d, t, 1, "x") for d, t in TEXTS], "doc_id long, text string, n_a int, digest string")
    want, held = rows_of(TEXTS, plain)
    found, pairs = T.token_alignment(docs, A, B)
    assert told(found) == want
    assert {(r.pair >> 32, r.pair % T.SPAN): r["count"] for r in pairs.collect()} == dict(held)
    monkeypatch.setattr(shared, "FEW", 2)
    assert told(T.token_alignment(docs, A, B)[0]) == want
    assert T.token_alignment(docs.limit(0), A, B)[0].count() == 0


def test_rare_pairs_are_joined(table, plain):
    docs = table(TEXTS, "doc_id long, text string")
    texts = shared.materialize(T.aligned(docs, A, B), "aligned")
    counts = shared.materialize(T.pair_counts(texts), "pairs")
    whole = sorted(map(tuple, T.looked_up(texts, counts).collect()))
    for usual in (1, 5, 40):
        assert sorted(map(tuple, T.looked_up(texts, counts, usual).collect())) == whole


def test_very_long_texts(plain):
    of = T.Aligner(A, B)
    for text in ("a" * 70_000, " " * 70_000, "x1 ,y\n" * 200_000):
        got = of(text)
        assert got[5].sum() >= max(got[:2]) and got[2] <= min(got[:2])
    text = "ab, cd\n" * 400
    got, want = of(text), plain(text)
    assert got[:4] == want[:4] and {(p >> 32, p % T.SPAN): n for p, n in zip(got[4].tolist(), got[5].tolist(), strict=True)} == want[4]


def test_other_tokenizers_take_the_plain_way():
    encode, _ = T.byte_level(vocabulary("word_bpe_49k.json"))
    want = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    assert encode("Some words, here.") == want.encode("Some words, here.", add_special_tokens=False).ids


def test_whole_table(spark, sf, plain):
    rows = [(r.doc_id, r.text) for r in shared.read(spark, sf, "documents").collect()]
    assert told(T.op12_cross_tokenizer_alignment(spark, sf)) == rows_of(rows, plain)[0]
