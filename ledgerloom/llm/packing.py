"""Operator 2, best-fit packing planned on the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens. Only the number of pieces of each
length (at most ``capacity`` numbers) reaches the driver, where best fit runs over counts:
equal bins are kept as one interval of sequence numbers, so the plan's size depends on the
capacity and not on the corpus. A piece takes its planned slot by joining on its rank
among the pieces of its length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import shared

CAPACITY = 4096
END_ID = 1
#: Pieces of one length that a task ranks together; more are dealt over salts.
RANKED_TOGETHER = 500
#: Words that a worker remembers; the memory forgets all beyond that.
REMEMBERED = 120_000
_SPACE = re.compile("[\t\n\x0b\x0c\r \x85\xa0  -     　]+")
_ODD = re.compile("[\x1c-\x1fΣ]|<\\|")
_TAIL = ".,;:!?*#$%&|\"()"
#: The way of cutting (fixed values of the public tokenizer) that words can be encoded one by one with; others encode whole texts.
_BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level tokenizers write bytes: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Tokens:
    """Token ids of texts as little-endian 32-bit bytes.

    The tokenizer cuts at white space and between letters and signs before it merges, so
    a text's ids are the ids of its words one after the other; each word is encoded once.
    Tokenizers that cut otherwise (``_BY_WORD``) are given whole texts. A text that is not in composed form, before or after lower-casing, goes word by word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.of = Tokenizer.from_file(path)
        spec = json.loads(self.of.to_str())
        self.by_word = all(spec[k] == v for k, v in _BY_WORD.items()) and not spec["post_processor"] and not spec["truncation"] and not spec["padding"]
        self.merge = self.of.model.tokenize
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.of.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            got = self.older.get(part)
            if got is None:
                if part.isalpha():  # one run of letters: nothing to cut, only to merge
                    got = b"".join([t.id.to_bytes(4, "little") for t in self.merge(part.encode().decode("latin1").translate(self.letters))])
                else:
                    got = self._ids(part)
            self.parts[part] = got
        return got

    def _learn(self, said: list[str]) -> dict[str, bytes]:
        """The ids of a text's distinct words; forgetting can't touch them."""
        own = {w: self.known.get(w) for w in {*said}}
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.parts) > REMEMBERED:
            self.older, self.parts = self.parts, {}
        for w, ids in own.items():
            if ids is None:
                core = w.rstrip(_TAIL)
                if core and core[-1].isalnum() and len(core) < len(w):
                    ids = self._part(core) + self._part(w[len(core) :])
                else:
                    ids = self._part(w)
                own[w] = self.known[w] = ids
        return own

    def __call__(self, text: str) -> bytes:
        if not self.by_word:
            return self._ids(text)
        low = text.lower()
        if _ODD.search(text) or not (text.isascii() or is_normalized("NFC", text) and is_normalized("NFC", low)):
            return b"".join(self._ids(x) for x in _SPACE.split(text) if x)
        said = low.split()
        try:
            return b"".join(map(self.known.__getitem__, said))
        except KeyError:
            return b"".join(map(self._learn(said).__getitem__, said))


_tokens: dict[str, Tokens] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): each text's tokens and an end token, cut at ``capacity``."""

    def cut(batches):
        if tokenizer not in _tokens:
            _tokens[tokenizer] = Tokens(tokenizer)
        encode, end = _tokens[tokenizer], END_ID.to_bytes(4, "little")
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                for k in range(0, len(ids), 4 * capacity):
                    own = ids[k : k + 4 * capacity]
                    for col, x in zip(rows, (doc_id, k // (4 * capacity), k // 4, len(own) // 4, zlib.crc32(own), own), strict=True):
                        col.append(x)
            out = [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=False)]
            if keep_ids:
                out.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in rows[5]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    shared.bounded_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(cut, schema)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, rank from, rank to, first sequence, pieces a sequence, offset).

    The pieces of rank q take sequence ``first + (q - from) // per`` at ``offset + (q - from) % per * length``.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens: intervals (first sequence, number) of such bins
    free: list[int] = []
    plan, bins = [], 0

    def put(r: int, first: int, n: int) -> None:
        if n and r:
            if r not in room:
                insort(free, r)
                room[r] = []
            room[r].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(free, length)
            if at < len(free):
                r = free[at]
                first, n = room[r].pop()
                if not room[r]:
                    del room[r], free[at]
            else:
                r, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            per = r // length
            full = min(n, left // per)
            if full:
                plan.append((length, rank, rank + full * per, first, per, capacity - r))
                put(r - per * length, first, full)
                rank, left, first, n = rank + full * per, left - full * per, first + full, n - full
            if n and 0 < left < per:
                plan.append((length, rank, rank + left, first, left, capacity - r))
                put(r - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            put(r, first, n)
    return plan


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null and empty texts are the end token alone. Repeated rows and repeated ids are packed
    each for itself, dealt over tasks like others; null ids too. Very long texts are encoded
    whole. An empty table gives no rows. Only texts longer than
    ``capacity`` are cut. Other columns are not looked at.
    """
    spark = docs.sparkSession
    parts = shared.materialize(pieces(docs, tokenizer, capacity, keep_ids).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = spark.createDataFrame(best_fit(counts, capacity), "length long, rank_from long, rank_to long, first long, per long, base long")
    salts = spark.createDataFrame([(n, -(-c // RANKED_TOGETHER)) for n, c in counts.items()], "length long, salts long")
    salted = parts.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("row"), "salts"))
    before = salted.groupBy("length", "salt").count().withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")).drop("count")
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "row")) - 1
    ranked = salted.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before"))
    slot = (ranked["length"] == plan["length"]) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    nth = F.col("rank") - F.col("rank_from")
    return ranked.join(F.broadcast(plan), slot).select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("base") + nth % F.col("per") * ranked["length"]).cast("long").alias("offset"), *(["ids"] if keep_ids else []),
    )


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public tokenizer of that name lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(shared.read(spark, sf_dir, "documents"), vocabulary())
