"""Operator 13, periodic runs: stretches of words that repeat with a period, by descending-LCP Kruskal.

The words of a batch of texts become numbers. Suffixes that share at least ``LEAST`` words
with another suffix of their text are found by hashes of so many words; the texts that have
such suffixes get a suffix array by prefix doubling, whose ranks tell the LCP of neighbours.
Neighbours are then united by decreasing LCP: each class is an ordered set of positions,
the smaller set moves into the larger, and positions that thereby become adjacent, at a
distance within the LCP, seed a run: it ends where the LCP of both ends, and begins at the
smallest position that seeds the same period and end. Texts are judged on their own, so
nothing is shuffled and a lost task costs only its own batches.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import shared

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words of texts that are sorted together.
TOGETHER = 1 << 18
Run = tuple[int, int, int]  # start, length, period
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def _least(min_length: int, min_exponent: int) -> int:
    """The first word of a run shares at least so many words with the word a period later."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def _repeated(ids: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Which positions start ``k`` words that start elsewhere in their text too (a superset: hashes decide)."""
    n = len(ids) - k + 1
    out = np.zeros(len(ids), bool)
    if n <= 0:
        return out
    h = doc[:n].astype(np.uint64)
    for j in range(k):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n].astype(np.uint64)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    order = at[np.argsort(h[at], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def suffix_neighbours(ids: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, next position in suffix order, LCP) for neighbours that share at least ``least`` words, within texts.

    ``doc`` numbers the texts, ascending; suffixes end with their text.
    """
    n = len(ids)
    key = doc.astype(np.int64) * (int(ids.max()) + 1) + ids
    sa = np.argsort(key, kind="stable")
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    ends = np.append(np.flatnonzero(doc[1:] != doc[:-1]) + 1, n)
    end = ends[np.searchsorted(ends, np.arange(n), "right")]  # where a position's text ends
    key = key[sa]
    levels, h = [], 1
    while True:  # ``rank`` tells the order by h words; only classes of several suffixes are sorted again
        first = np.append(True, key[1:] != key[:-1])
        heads = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        rank[sa[slots]] = heads
        levels.append(rank.astype(np.int32))
        several = ~(first & np.append(first[1:], True))
        slots, heads = slots[several], heads[several]
        if not len(slots):
            break
        at = sa[slots]
        far = at + h
        key = heads * (n + 1) + np.where(far < end[at], rank[np.minimum(far, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        sa[slots], key = at[order], key[order]
        h *= 2
    a, b = sa[:-1], sa[1:]
    own = doc[a] == doc[b]
    a, b = a[own], b[own]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + lcp, b + lcp
        inside = (i < end[a]) & (j < end[b])
        same = inside & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        lcp += same.astype(np.int64) << k
    long = lcp >= least
    return a[long], b[long], lcp[long]


def kruskal_seeds(left: list[int], right: list[int], lcp: list[int], min_exponent: int) -> dict[tuple[int, int], int]:
    """(end, period) -> start of the runs that newly adjacent positions seed; neighbours come by decreasing LCP.

    Only seeds whose LCP holds the period ``min_exponent - 1`` times are kept: the first word of a long enough run is one.
    """
    parent: dict[int, int] = {}
    held: dict[int, list[int]] = {}
    found: dict[tuple[int, int], int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    def seed(i: int, j: int, shares: int) -> None:
        if (j - i) * (min_exponent - 1) <= shares:
            key = (j + shares, j - i)
            if found.get(key, i) >= i:
                found[key] = i

    for i, j, shares in zip(left, right, lcp, strict=True):
        i, j = root(i), root(j)
        small, large = held.pop(i, None) or [i], held.pop(j, None) or [j]
        if len(small) > len(large):
            small, large, i, j = large, small, j, i
        parent[i] = j
        held[j] = large
        before = -1  # the last that moved
        for n, x in enumerate(small):
            at = bisect_left(large, x)
            if at and large[at - 1] != before:
                seed(large[at - 1], x, shares)
            if at < len(large) and (n + 1 == len(small) or large[at] < small[n + 1]):
                seed(x, large[at], shares)
            if at == len(large):
                large.append(x)
            else:
                large.insert(at, x)
            before = x
    return found


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[Run]]:
    """The maximal runs of each text (a list of words), by start and period."""
    out: list[list[Run]] = [[] for _ in texts]
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for words in texts for w in words], np.int64)
    if not len(ids):
        return out
    doc = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
    least = _least(min_length, min_exponent)
    having = np.zeros(len(texts), bool)
    having[doc[_repeated(ids, doc, least)]] = True
    if not having.any():
        return out
    begins = np.append(0, np.cumsum([len(words) for words in texts]))
    own = having[doc]
    ids, doc, was = ids[own], doc[own], np.flatnonzero(own)
    left, right, lcp = suffix_neighbours(ids, doc, least)
    order = np.argsort(-lcp, kind="stable")
    found = kruskal_seeds(left[order].tolist(), right[order].tolist(), lcp[order].tolist(), min_exponent)
    for (end, period), start in found.items():
        if end - start >= max(min_length, min_exponent * period):
            d = int(doc[start])
            insort(out[d], (int(was[start] - begins[d]), end - start, period), key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds beyond its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def _groups(batch: pa.RecordBatch, rewrite: Rewrite | None) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of so many texts that they have some TOGETHER words."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        words = (text.as_py() or b"").split()  # exactly at the blanks from 09 to 0D and 20
        words = rewrite(doc_id, words) if rewrite else words
        ids.append(doc_id)
        texts.append(words)
        held += len(words)
        if held >= TOGETHER:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


_SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string"
_ARROW = pa.schema({"doc_id": pa.int64(), "runs": pa.list_(pa.struct({"start": pa.int64(), "length": pa.int64(), "period": pa.int64()})), "text": pa.string()})


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, rewrite: Rewrite | None = None) -> DataFrame:
    """``doc_id, runs, text`` per row of ``docs`` (``doc_id``, ``text``; other columns are not looked at).

    ``runs`` (start, length, period in words, by start and period) are the maximal stretches
    of at least ``min_length`` words and ``min_exponent`` (2 or more) times their smallest
    period; ``text`` has the words that stay when each run shrinks to its first period, one
    space between them. ``rewrite(doc_id, words)`` may change a text's words first. Null and
    empty texts have no words, no runs and an empty text. Rows that repeat an id or a text,
    and null ids, get rows of their own. Very long texts are taken whole, in a task of
    their own words. Equal candidates can't tie: a run is told by its end and period. An
    empty table gives no rows.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("runs of at least two words and periods")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _groups(batch, rewrite):
                found = runs_of(texts, min_length, min_exponent)
                told = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
                left = [b" ".join(collapsed(words, runs)).decode() for words, runs in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, told, left), _ARROW, strict=True)], schema=_ARROW)

    shared.bounded_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").cast("binary").alias("text")).mapInArrow(each, _SCHEMA)


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten, by the checksum of its id, goes on with a stretch of its words again and again."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    found = periodic_runs(shared.read(spark, sf_dir, "documents"), rewrite=repeated_tail)
    key = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.array_max(key)
    rows = found.withColumn("best", best)
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )
