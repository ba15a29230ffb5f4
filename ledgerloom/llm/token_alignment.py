"""Operator 12, alignment of two tokenizers over the distinct texts of a corpus.

Documents are shuffled by their full text and counted; each distinct text is tokenised and
aligned once. Its distinct linked id pairs weigh as many documents as have the text, and
are summed up over the corpus. Each text's links then look their pairs' counts up, and the
texts' measures come back to document ids by a digest of the text.

Byte-level BPE merges the same bytes whichever library does it, so A's file is read as
ranks for the faster one where its merges are in the order of their ids (``Aligner``).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import shared
from ledgerloom.llm.packing import _byte_letters, vocabulary

#: The most usual pairs, so many at most, are broadcast (16 bytes each); links of all others are joined.
USUAL = 1_000_000
#: A pair is one number: id of A times SPAN plus id of B.
SPAN = 1 << 32
_SPACE = "▁"


#: The way of cutting (a fixed value of byte-level tokenizers) that ``byte_level`` knows.
_CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def align(a: np.ndarray, len_a: np.ndarray, b: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, groups of A's tokens, groups of B's): ids over the same bytes, with their tokens' byte lengths.

    Two tokens overlap on exactly one stretch between neighbouring ends of either side, so
    each such stretch is a link; where both sides end, a group ends.
    """
    ends_a, ends_b = np.cumsum(len_a), np.cumsum(len_b)
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    again = np.append(False, ends[1:] == ends[:-1])  # a side's own ends differ
    both, ends = ends[again], ends[~again]
    pairs = a[np.searchsorted(ends_a, ends)] * SPAN + b[np.searchsorted(ends_b, ends)]
    return pairs, np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)


def byte_level(path: str):
    """The ids that the tokenizer in this file gives to a text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tiktoken import Encoding
    from tokenizers import Tokenizer

    of = Tokenizer.from_file(path)
    of.encode_special_tokens = True
    spec = json.loads(of.to_str())
    model, vocab = spec["model"], of.get_vocab(with_added_tokens=False)
    back = {c: b for b, c in _byte_letters().items()}
    ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if all(c in back for c in t)}
    plain = lambda text: of.encode(text, add_special_tokens=False).ids
    merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    same = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and not any(spec[k] for k in ("normalizer", "post_processor", "truncation", "padding"))
    if not same or model["type"] != "BPE" or any(x >= y for x, y in pairwise(merged)) or not {bytes([b]) for b in range(256)} <= ranks.keys():
        return plain, ranks
    for t in spec["added_tokens"]:
        ranks.pop(t["content"].encode(), None)
    quick = Encoding("ranks", pat_str=_CUTS, mergeable_ranks=ranks, special_tokens={})
    return lambda text: plain(text) if len(text) >= _LONG and any(m.end() - m.start() >= _LONG for m in _RUNS.finditer(text)) else quick.encode_ordinary(text), ranks


#: Runs with or without white space from this length on are left to the library that takes them in steady time.
_LONG, _RUNS = 1 << 16, re.compile(r"\s+|\S+")


class Aligner:
    """Tokens of both tokenizers, and what they say about a text."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a, ranks = byte_level(path_a)
        of = SentencePieceProcessor(model_file=path_b)
        self.b = of.encode
        said = [of.id_to_piece(i) for i in range(of.get_piece_size())]
        self.bytes_b = [bytes([int(t[3:5], 16)]) if of.is_byte(i) else t.replace(_SPACE, " ").encode() for i, t in enumerate(said)]
        self.len_a, self.len_b = np.zeros(max(ranks.values()) + 1, np.int64), np.array([len(t) for t in self.bytes_b], np.int64)
        for t, i in ranks.items():
            self.len_a[i] = len(t)
        self.written = [f"{i}{sign}" for sign in ",|;" for i in range(max(len(self.len_a), len(self.len_b)))]  # an id and what follows it

    def _groups(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``"""
        n = len(self.written) // 3
        sign = [np.append(g[1:] != g[:-1], True) * k * n for k, g in ((1, of_a), (2, of_b))]
        order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
        codes = np.concatenate([a + sign[0], b + sign[1]])[order]
        return "".join(map(self.written.__getitem__, codes.tolist()))[:-1]

    def __call__(self, text: str) -> tuple[int, int, int, str, np.ndarray, np.ndarray] | None:
        """n_a, n_b, n_groups, digest of the groups, linked pairs and their numbers; None where tokens don't give back the text."""
        raw = (" " + text).encode()
        a, b = self.a(" " + text), self.b(text)
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        len_a = self.len_a[a]
        if len_a.sum() != len(raw):  # byte-level tokens are the text's bytes, or leave unknown ones out
            return None
        pairs, of_a, of_b = align(a, len_a, b, self.len_b[b])
        return len(a), len(b), int(of_a[-1]) + 1, hashlib.sha256(self._groups(a, b, of_a, of_b).encode()).hexdigest(), *np.unique(pairs, return_counts=True)


_aligners: dict[tuple[str, str], Aligner] = {}
_ARROW = pa.schema({"digest": pa.binary(), "docs": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "groups_sha256": pa.string(), "links": pa.map_(pa.int64(), pa.int32())})


def _digest(text):
    return F.unhex(F.sha2(text, 256))


def aligned(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """A row for each distinct text: digest, docs (rows that have it), n_a, n_b, n_groups, groups_sha256, links (pair -> number)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer_a, tokenizer_b)
        if key not in _aligners:
            _aligners[key] = Aligner(*key)
        of = _aligners[key]
        for batch in batches:
            rows, pairs, numbers, at = [], [], [], [0]
            for digest, n, text in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                told = of(text.as_py())
                rows.append((digest.as_py(), n.as_py(), *(told[:4] if told else (0, 0, 0, ""))))
                if told:
                    pairs.append(told[4])
                    numbers.append(told[5])
                at.append(at[-1] + (len(told[4]) if told else 0))
            cols = [pa.array(c, f.type) for c, f in zip([*zip(*rows, strict=True)] or [[]] * 6, _ARROW, strict=False)]
            joined = [np.concatenate(x) if x else np.array([], np.int64) for x in (pairs, numbers)]
            links = pa.MapArray.from_arrays(pa.array(at, pa.int32()), pa.array(joined[0], pa.int64()), pa.array(joined[1].astype(np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays([*cols, links], schema=_ARROW)

    shared.bounded_batches(docs.sparkSession)
    texts = docs.select(docs["text"].cast("string").alias("text")).filter("text <> ''").groupBy("text").agg(F.count("*").alias("docs"))
    schema = "digest binary, docs long, n_a long, n_b long, n_groups long, groups_sha256 string, links map<long,int>"
    return texts.select(_digest(F.col("text")).alias("digest"), "docs", "text").mapInArrow(each, schema)


def pair_counts(texts: DataFrame) -> DataFrame:
    """``pair, count, best``: documents that hold each id pair linked, and whether that is the most for its id of A."""
    n = texts.select(F.explode(F.map_keys("links")).alias("pair"), "docs").groupBy("pair").agg(F.sum("docs").alias("count"))
    n = shared.materialize(n, "pair_counts")
    a = F.shiftright("pair", 32)
    most = n.groupBy(a.alias("a")).agg(F.max("count").alias("most"))  # a row for each id of A: a vocabulary at most
    return n.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def looked_up(texts: DataFrame, counts: DataFrame, usual: int = USUAL) -> DataFrame:
    """``digest, n_links, n_best, count_sum``: each text's links with their pairs' counts.

    The most usual pairs, no more than ``usual``, are broadcast; links of the others are
    few, and joined by pair. No link is left out.
    """
    total = counts.count()
    links = texts.select("digest", F.explode("links").alias("pair", "n"))
    if total > usual:
        at = counts.stat.approxQuantile("count", [1 - usual / 2 / total], 0.1 * usual / total)[0]
        often = counts.filter(F.col("count") > at)
        while often.count() > usual:  # ties, or a quantile that is off
            at = 2 * at + 1
            often = counts.filter(F.col("count") > at)
        rare = shared.materialize(links.join(F.broadcast(often.select("pair")), "pair", "left_anti"), "rare_links").join(counts.filter(F.col("count") <= at), "pair")
        met = links.join(F.broadcast(often), "pair")
        parts = [_summed(met), _summed(rare)]
        return _summed(parts[0].unionByName(parts[1]), summed=True)
    return _summed(links.join(F.broadcast(counts), "pair"))


def _summed(met: DataFrame, summed: bool = False) -> DataFrame:
    if summed:
        return met.groupBy("digest").agg(*[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")])
    return met.groupBy("digest").agg(F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))


def token_alignment(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> tuple[DataFrame, DataFrame]:
    """(measures per row of ``docs``, ``pair_counts``); of ``docs`` only ``doc_id`` and ``text`` are looked at.

    Measures: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Null
    and empty texts, and texts that either tokenizer's bytes don't give back, have no tokens:
    zeros and an empty string. Rows that repeat a text or an id each get a row of their own
    and count as a document each; null ids too. A pair that ties for the most documents of
    its id is best like the other. Very long texts are aligned whole. An empty table gives
    no rows.
    """
    texts = shared.materialize(aligned(docs, tokenizer_a, tokenizer_b), "aligned")
    counts = shared.materialize(pair_counts(texts), "pairs")
    measured = texts.drop("links").join(looked_up(texts, counts), "digest", "left")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), _digest(docs["text"].cast("string")).alias("digest"))
    hot = shared.hot_keys(texts, ["digest"], "docs")
    told = shared.salted_join(rows, measured.drop("docs"), ["digest"], hot, F.col("doc_id"), "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}
    return told.select("doc_id", *zero.values(), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")), counts


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(shared.read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))[0]
