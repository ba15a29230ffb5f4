"""Operator 10, benchmark decontamination by Wu-Manber multi-pattern search over words.

Each item's windows of ten words are the patterns (an item of fewer words is one shorter
pattern). Patterns of one length share a block shift table: for a block of words it holds
how far a window may move because no pattern has that block nearer to its end. Text is
probed only every ``length - block + 1`` words; where the probed block occurs in some
pattern, the window ends that its shift leaves possible are looked at. Those with shift 0
select a bucket by the hash of their suffix, prefix and inner words, and the bytes are compared.
Patterns are sorted hashes that point into one buffer of item text.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bytewise as bw
from ledgerloom.llm import shared

WINDOW = 10
#: Megabytes that a worker's tables may take; they take some 14 bytes for each byte of item text.
MATCHER_MB = 160
#: Bytes of item text per block of the query set; each block is a pass of its own over the texts.
BLOCK_BYTES = (MATCHER_MB << 20) // 14
#: Words of an item that a slice of it begins; slices share WINDOW - 1 words.
SLICE = 4096
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _block(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of ``size`` words at each position."""
    x = h[at]
    for k in range(1, size):
        x = bw.mix64(x * _MUL + h[at + k])
    return x


def _equal(a: np.ndarray, a_from: np.ndarray, b: np.ndarray, b_from: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``a[a_from[i]:a_from[i] + size[i]]`` equals the bytes of ``b`` at ``b_from[i]``, some at a time."""
    out = np.ones(len(size), bool)
    for lo in range(0, len(size), 4096):
        n = size[lo : lo + 4096]
        first = np.cumsum(n) - n
        nth = np.arange(n.sum()) - np.repeat(first, n)
        differs = a[np.repeat(a_from[lo : lo + 4096], n) + nth] != b[np.repeat(b_from[lo : lo + 4096], n) + nth]
        out[lo : lo + 4096] = np.add.reduceat(np.append(differs, False), np.minimum(first, len(differs)))[: len(n)] == 0 if len(differs) else True
        out[lo : lo + 4096] |= n == 0
    return out


class _Length:
    """Patterns of ``m`` words: where each distinct one stands in the items' words, its bucket, and the items that hold it."""

    def __init__(self, w: bw.Words, m: int, start: np.ndarray, item: np.ndarray):
        self.m, self.words = m, w
        self.size = min(2, m)
        self.step = m - self.size + 1
        h = w.hash
        bits = int(np.clip(np.ceil(np.log2(8 * len(start) * self.step + 1)), 18, 22))
        self.right = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, self.step, np.uint8)
        for j in range(self.step):  # later blocks have smaller shifts
            self.shift[self._slot(_block(h, start + j, self.size))] = self.step - 1 - j
        key = self._key(h, start)
        order = np.argsort(key, kind="stable")
        start, key, item = start[order], key[order], item[order]
        del order
        new = np.concatenate(([True], key[1:] != key[:-1]))
        same = np.flatnonzero(~new)
        new[same] = ~self._alike(w, start[same], start[same - 1])
        self.start, self.bucket = start[new], key[new]
        del start, key
        most = int(item.max()) + 1
        once = np.cumsum(new) - 1
        once *= most
        once += item
        once.sort()
        once = once[np.concatenate(([True], once[1:] != once[:-1]))]
        self.items = (once % most).astype(np.int32)
        self.first_item = np.searchsorted(once, np.arange(len(self.start) + 1) * most).astype(np.int32)

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return x >> self.right

    def _key(self, h: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The bucket of a pattern: its last and first blocks, then all of its words."""
        x = bw.mix64(_block(h, start + (self.step - 1), self.size) * _MUL + _block(h, start, self.size))
        for k in range(self.size, self.step - 1):
            x *= _MUL
            x += h[start + k]
        return bw.mix64(x)

    def _alike(self, w: bw.Words, at: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Whether the ``m`` words of ``w`` from each of ``at`` are those of the items from ``own``, byte by byte."""
        same = np.ones(len(at), bool)
        for k in range(self.m):
            left = np.flatnonzero(same)
            a, b = at[left] + k, own[left] + k
            n = w.end[a] - w.start[a]
            fits = n == self.words.end[b] - self.words.start[b]
            same[left[~fits]] = False
            left, a, b, n = left[fits], a[fits], b[fits], n[fits]
            same[left] = _equal(w.folded, w.start[a], self.words.folded, self.words.start[b], n)
        return same

    def find(self, w: bw.Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every occurrence; words count through the whole chunk."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        h, last = w.hash, len(w.hash) - self.size
        if len(h) < self.m:
            return none
        probe = np.arange(self.step - 1, last + 1 + self.step, self.step)
        shift = self.shift[self._slot(_block(h, np.minimum(probe, last), self.size))].astype(np.int64)
        alive = shift < self.step
        probe, shift = probe[alive], shift[alive]
        left = self.step - shift  # window ends from probe + shift up to the next probe
        total = int(left.sum())
        if not total:
            return none
        end = np.repeat(probe + shift - np.concatenate(([0], np.cumsum(left)[:-1])), left) + np.arange(total)
        end = end[end <= last]
        end = end[self.shift[self._slot(_block(h, end, self.size))] == 0]
        start = end - (self.step - 1)
        row = np.searchsorted(w.first, start, "right") - 1
        start = start[start + self.m <= w.first[row + 1]]
        key = self._key(h, start)
        lo, hi = np.searchsorted(self.bucket, key, "left"), np.searchsorted(self.bucket, key, "right")
        n = hi - lo
        at = np.repeat(start, n)
        pattern = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        said = self._alike(w, at, self.start[pattern])
        return at[said], pattern[said]


class Matcher:
    """The patterns of one block of the query set: sorted hashes over one byte buffer, by length.

    ``items`` are ids (null ones too), ``said`` their words in lower case, parted by spaces.
    """

    def __init__(self, items: pa.Array, said: pa.Array):
        names = pc.dictionary_encode(items.cast(pa.string()), null_encoding="encode")
        self.names, code = names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        self.lengths: list[_Length] = []
        chunk = next(bw.chunks(said, most=1 << 60), None)
        if chunk is None:
            return
        w = bw.words(chunk, bw.ALNUM)
        w = bw.Words(w.start.astype(np.int32), w.end.astype(np.int32), w.hash, w.first, chunk.data.copy())
        n = np.diff(w.first)
        for m in np.unique(np.minimum(n, WINDOW)[n > 0]).tolist():
            own = np.flatnonzero(np.minimum(n, WINDOW) == m)
            many = n[own] - m + 1
            start = np.repeat((w.first[own] - (np.cumsum(many) - many)).astype(np.int32), many)
            start += np.arange(len(start), dtype=np.int32)
            self.lengths.append(_Length(w, m, start, np.repeat(code[own], many)))
        w.hash = w.hash[:0]  # needed for the tables only

    def __call__(self, texts: pa.Array) -> tuple[list, list, list]:
        """Per row: number of words, occurrences as 16 * first word + length, items (null last)."""
        n_words, spans, items = [], [], []
        for c in bw.chunks(texts):
            w = bw.words(c, bw.ALNUM)
            n_words += np.diff(w.first).tolist()
            own_spans, own_items = [[] for _ in range(c.rows)], [set() for _ in range(c.rows)]
            for one in self.lengths:
                start, pattern = one.find(w)
                row = np.searchsorted(w.first, start, "right") - 1
                for r, x, p in zip(row.tolist(), ((start - w.first[row]) * 16 + one.m).tolist(), pattern.tolist(), strict=True):
                    own_spans[r].append(x)
                    own_items[r].update(one.items[one.first_item[p] : one.first_item[p + 1]].tolist())
            spans += own_spans
            items += [sorted((self.names[i] for i in x), key=lambda i: (i is None, i or "")) for x in own_items]
        return n_words, spans, items

    def any(self, texts: pa.Array) -> np.ndarray:
        """Whether each row holds a pattern."""
        out = np.zeros(len(texts), bool)
        for c in bw.chunks(texts):
            w = bw.words(c, bw.ALNUM)
            for one in self.lengths:
                out[c.first + np.searchsorted(w.first, one.find(w)[0], "right") - 1] = True
        return out


def _slices(batches):
    """(item, words in lower case parted by spaces) of each item, long ones in slices that no window is lost between."""
    for b in batches:
        items, said = [], []
        for item, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            for c in bw.chunks(pa.array([text.as_py() or ""])):
                w = bw.words(c, bw.ALNUM)
                for at in range(0, max(1, len(w.start) - WINDOW + 1), SLICE):
                    own = slice(at, at + SLICE + WINDOW - 1)
                    items.append(item)
                    said.append(b" ".join(w.folded[x:y].tobytes() for x, y in zip(w.start[own], w.end[own], strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(said, pa.binary())], names=["item", "said"])


#: The tables of the block that a worker searches for; a block's tables are made once in a worker and make way for the next.
_made: dict[str, Matcher] = {}


def _matchers(benchmark: DataFrame):
    """For each block of the query set a function that makes or finds its ``Matcher`` in a worker.

    Executors cut the items; the driver sees one block of about ``BLOCK_BYTES`` at a time.
    """
    spark = benchmark.sparkSession
    shared.bounded_batches(spark)
    items = benchmark.select(benchmark["item_id"].cast("string").alias("item"), benchmark["text"].cast("string").alias("text"))
    cut = shared.materialize(items.mapInArrow(_slices, "item string, said binary").filter("length(said) > 0").withColumn("n", F.monotonically_increasing_id()), "slices")
    blocks = max(1, -(-(cut.agg(F.sum(F.length("said"))).first()[0] or 0) // BLOCK_BYTES))
    for k in range(blocks):
        rows = cut.filter(F.pmod(F.xxhash64("n"), F.lit(blocks)) == k).select("item", "said").toArrow()
        shipped, name = spark.sparkContext.broadcast((rows["item"].combine_chunks(), rows["said"].combine_chunks())), uuid.uuid4().hex

        def matcher(shipped=shipped, name=name) -> Matcher:
            if name not in _made:
                _made.clear()
                _made[name] = Matcher(*shipped.value)
            return _made[name]

        yield matcher, k + 1 == blocks
        shipped.unpersist()  # asked for the next one: this one's findings are written


_FIELDS = "n_words long, spans array<long>, items array<string>"


def _n_hit(spans: Column) -> Column:
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), F.shiftright(x, 4) + x % 16 - F.greatest(F.shiftright(x, 4), acc["to"]))).alias("n"),
            F.greatest(acc["to"], F.shiftright(x, 4) + x % 16).alias("to"),
        ),
        lambda acc: acc["n"],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``doc`` (struct of the columns ``keep``, all where None), n_words, spans, n_hit, items, contaminated for every row.

    ``spans`` holds 16 * first word + length of each occurrence, ``items`` the ids of the
    items that occur, as sorted strings. A null or empty text has no words and is clean;
    so is every text where the benchmark has no rows or no words. Items without an id count
    as one, a null at the end of ``items``. Repeated rows and repeated ids are judged row by
    row; items that share a window all count. Very long texts and items are read whole. The
    benchmark is taken in blocks of about ``BLOCK_BYTES``, each a pass over the texts, whose
    findings are written; a worker holds the tables of one block.
    """
    found = []
    rows = doc = None
    for matcher, last in _matchers(benchmark):
        search = lambda texts, matcher=matcher: matcher()(texts)
        if last and rows is None:  # the usual case: one pass
            out = bw.annotate(docs, search, _FIELDS, keep).withColumnRenamed("row", "doc")
            break
        if rows is None:
            doc = F.struct("*") if keep is None else F.struct(*[docs[c] for c in keep])
            rows = shared.materialize(docs.select(doc.alias("doc"), docs["text"].cast("string").alias("text"), F.monotonically_increasing_id().alias("row")), "texts")
            out = shared.materialize(bw.annotate(rows, search, _FIELDS, ("doc", "row")), "found").select("row.doc", "row.row", "n_words", "spans", "items")
            found.append(out.filter("size(spans) > 0").select("row", "spans", "items"))
            out = out.select("doc", "row", "n_words")
            continue
        found.append(shared.materialize(bw.annotate(rows, search, _FIELDS, ("row",)).filter("size(spans) > 0").select("row.row", "spans", "items"), "found"))
    if found:
        none = lambda kind: F.array().cast(f"array<{kind}>")
        every = reduce(DataFrame.union, found).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        out = out.join(every, "row", "left").select("doc", "n_words", F.coalesce("spans", none("long")).alias("spans"), F.coalesce("items", none("string")).alias("items"))
    out = out.withColumns({"spans": F.array_sort("spans"), "items": F.array_sort("items")})
    return out.withColumn("n_hit", _n_hit(F.col("spans"))).withColumn("contaminated", F.size("spans") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs; what a block's pass leaves goes into the next one's."""
    for matcher, last in _matchers(benchmark):
        docs = bw.where(docs, lambda texts, matcher=matcher: ~matcher().any(texts))
        docs = docs if last else shared.materialize(docs, "clean")
    return docs


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(shared.read(spark, sf_dir, "documents"), shared.read(spark, sf_dir, "benchmark"), keep=("doc_id",))
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


OP10_SQL = r"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(10, len(ws)) AS m, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS p
        FROM b, unnest(range(1, CAST(len(ws) - least(10, len(ws)) + 2 AS BIGINT))) AS r(i) WHERE len(ws) > 0),
m AS (SELECT DISTINCT m FROM pat),
occ AS (SELECT doc_id, i, m.m, array_to_string(ws[i:i + m.m - 1], ' ') AS p FROM w, m, unnest(range(1, CAST(len(ws) - m.m + 2 AS BIGINT))) AS r(i) WHERE len(ws) >= m.m),
hit AS (SELECT doc_id, i, occ.m, item_id FROM occ JOIN pat ON occ.m = pat.m AND occ.p = pat.p),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(i, i + m)) AS r(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
