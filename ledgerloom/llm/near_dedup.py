"""Operator 1, near-duplicates by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit universe suffice: the first scatters the shingles, the
second, shifted circularly by k, gives coordinate k of the signature. Texts with equal
word sequences are one class; only one document of a class goes on. Bands of equal
coordinates make buckets. Buckets are not paired out: each first links its members to its
most central one, its pivot. Buckets of one pivot are one group, so that a member stands in
a group once however many buckets it shares. Where a group still holds several components its
members are compared on whole sets, and a task tells no more links than it has members. Large groups
are parted before that by what sets differ in from their pivot (``_parted``), without loss.
Every link is confirmed on whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import bytewise as bw
from ledgerloom.llm import shared
from ledgerloom.llm.components import components

SHINGLE = 5
COORDINATES, BANDS = 64, 16
ROWS = COORDINATES // BANDS
#: Links are confirmed where 100 * intersection >= PERCENT * union, unless another percentage is asked for.
PERCENT = 85
#: Below PERCENT the coordinates are banded twice, as they stand and strided: no two bands of
#: the two kinds share more than one coordinate.
_STRIDED = np.arange(COORDINATES).reshape(ROWS, BANDS).T.ravel()
#: Coordinates that must agree before sets are compared. At similarity 0.8 about 51 of 64 agree
#: (standard deviation 3.2); a pair at 0.8 falls below this with a probability of 5e-7, one at 0.85 of 3e-10.
AGREE = 34
#: Members of a group, and shingles of these, that make a block; a task compares two blocks. Groups
#: of more than PARTED blocks of members are parted, LEVELS times at most.
BLOCK, VOLUME, PARTED, LEVELS = 128, 1 << 21, 8, 1
_M32 = np.uint32


def _scatter(x: np.ndarray) -> np.ndarray:
    """First permutation of the 32-bit universe."""
    x = x ^ (x >> _M32(16))
    x *= _M32(0x7FEB352D)
    x ^= x >> _M32(15)
    x *= _M32(0x846CA68B)
    x ^= x >> _M32(16)
    return x


def signatures(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows of COORDINATES minima for the sets ``shingles[first[i]:first[i + 1]]``, none of them empty."""
    out = np.empty((len(first) - 1, COORDINATES), _M32)
    at = _scatter((shingles >> np.uint64(32)).astype(_M32))
    x, y = np.empty_like(at), np.empty_like(at)
    for k in range(COORDINATES):
        np.subtract(at, _M32(k), out=x)  # the second permutation, shifted by k around the universe
        np.right_shift(x, _M32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, _M32(0x21F0AAAD), out=x)
        np.right_shift(x, _M32(15), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, _M32(0xD35A2D97), out=x)
        np.right_shift(x, _M32(15), out=y)
        np.bitwise_xor(x, y, out=x)
        out[:, k] = np.minimum.reduceat(x, first[:-1])
    return out


def band_keys(sig: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    if percent < PERCENT:
        sig = np.hstack([sig, sig[:, _STRIDED]])
    bands = sig.shape[1] // ROWS
    keys = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, np.uint64)
        for c in range(ROWS):
            h = bw.mix64(h * np.uint64(bw.SEQ[0]) + sig[:, b * ROWS + c])
        keys[:, b] = h
    return keys.view(np.int64)


def shingle_sets(chunk: bw.Chunk) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per row the sorted distinct 64-bit shingles; two hashes of its word sequence; its number of words."""
    w = bw.words(chunk, bw.NOT_SPACE)
    n = np.diff(w.first)
    seq = [bw.mix64(bw.span_hash(bw.prefix_hash(w.hash, base), w.first[:-1], w.first[1:]) + n.astype(np.uint64)) for base in bw.SEQ]
    h = w.hash
    if len(h) >= SHINGLE:
        roll = h[: len(h) - SHINGLE + 1].copy()
        for k in range(1, SHINGLE):
            roll *= np.uint64(bw.SEQ[1])
            roll += h[k : len(h) - SHINGLE + 1 + k]
        roll = bw.mix64(roll)
    else:
        roll = h[:0]
    sets = []
    for i in range(chunk.rows):
        a, k = w.first[i], n[i]
        sets.append(np.unique(roll[a : a + k - SHINGLE + 1]) if k >= SHINGLE else seq[0][i : i + 1] if k else roll[:0])
    return sets, np.stack(seq), n


def _sign(texts: pa.Array, percent: int) -> list:
    size, one, two, sigs, keys = [], [], [], [], []
    for c in bw.chunks(texts):
        sets, seq, _ = shingle_sets(c)
        n = np.array([len(s) for s in sets])
        full = np.flatnonzero(n)
        size.append(n)
        one.append(seq[0].view(np.int64))
        two.append(seq[1].view(np.int64))
        own_sig, own_keys = [None] * len(n), [None] * len(n)
        if len(full):
            sig = signatures(np.concatenate([sets[i] for i in full]), np.concatenate(([0], np.cumsum(n[full]))))
            for i, s, k in zip(full, sig.view(np.int32), band_keys(sig, percent), strict=True):
                own_sig[i], own_keys[i] = s, k
        sigs += own_sig
        keys += own_keys
    if not size:
        return [[], [], [], [], []]
    return [np.concatenate(size).astype(np.int64), np.concatenate(one), np.concatenate(two), pa.array(sigs, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))]


def _sets(texts: pa.Array) -> list:
    return [pa.array([s.view(np.int64) for c in bw.chunks(texts) for s in shingle_sets(c)[0]], pa.list_(pa.int64()))]


def _close(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs (member, pivot) whose signatures agree often enough."""
    agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda a, b: a == b), lambda x: x))
    left = pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
    return left.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b").filter(agree >= AGREE).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets are similar enough, as edges."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("set_a")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("set_b")), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.filter(100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)).select(F.col("a").alias("u"), F.col("b").alias("v"))


_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


class _Common:
    """Numbers of common values of one row of a list column with later rows."""

    def __init__(self, lists: pa.ChunkedArray):
        lists = lists.combine_chunks()
        self.first = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        self.codes = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)[1]
        self.mark = np.zeros(len(self.codes), np.uint8)

    def __call__(self, i: int, later: int) -> np.ndarray:
        own = self.codes[self.first[i] : self.first[i + 1]]
        self.mark[own] = 1
        common = np.add.reduceat(self.mark[self.codes[self.first[later] :]], self.first[later:-1] - self.first[later], dtype=np.int64)
        self.mark[own] = 0
        return common


def _joining(table: pa.Table, left: int, each: bool, lists: str, linked) -> pa.Table:
    """Links that join components: of each of the first ``left`` rows with all rows behind it (``each``) or behind the first ``left``.

    ``linked(i, later, common)`` tells which rows from ``later`` on are linked with row i. No list is empty.
    """
    ids, comp = table.column("id").to_numpy(), table.column("component").to_numpy().copy()
    count, a, b = _Common(table.column(lists)), [], []
    for i in range(left):
        later = i + 1 if each else left
        if later < len(ids) and (comp[later:] != comp[i]).any():
            for j in later + np.flatnonzero(linked(i, later, count(i, later)) & (comp[later:] != comp[i])):
                if comp[i] != comp[j]:
                    a.append(ids[i])
                    b.append(ids[j])
                    comp[comp == comp[j]] = comp[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _block_links(key, table, percent):
    """Links between different components within one block, or between two."""
    low, high = key[1].as_py(), key[2].as_py()
    table = table.sort_by([("block", "ascending"), ("id", "ascending")])
    size = table.column("hashes").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    linked = lambda i, later, common: 100 * common >= percent * (size[later:] + size[i] - common)
    left = len(size) if low == high else int((table.column("block").to_numpy() == low).sum())
    return _joining(table, left, low == high, "hashes", linked)


def _in_blocks(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within the groups of ``rest`` (group, id, component, size; n, volume of the group), block by block."""
    rest = rest.withColumn("blocks", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("volume") / VOLUME)).cast("int")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "id", "component", "block")
    return rest.join(sets, "id").groupBy("group", "low", "high").applyInArrow(lambda key, table: _block_links(key, table, percent), _LINK)


def _part_links(key, table, percent):
    """Links between probes and targets of one part, or of one block of either."""
    table = table.sort_by([("probe", "descending"), ("id", "ascending")])
    excess = table.column("excess").to_numpy()
    linked = lambda i, later, common: 2 * (100 + percent) * common >= excess[later:] + excess[i]
    return _joining(table, int(table.column("probe").to_numpy(zero_copy_only=False).sum()), False, "own", linked)


def _parted(rest: DataFrame, hot: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within large groups of ``rest`` (group, id, component), from what sets differ in from their pivot.

    Let d(i) be the shingles that only one of the set i and the pivot p has, and K, L = 100 +
    percent, 100 - percent. Sets i and j differ in |d(i)| + |d(j)| - 2 |d(i) & d(j)| shingles
    and are linked where K times that is at most L (|i| + |j|), that is where 2 K |d(i) & d(j)| is at
    least their excesses' sum; the excess of i is K |d(i)| - L |i|. It is more than L |p| for sets that
    aren't linked with the pivot and at least -L |p| for all. Members linked with the pivot are
    in one component, so one of a pair, the probe, may be taken as not linked with it. Either side
    therefore knows how many shingles of d it must share at least, and the first one that
    both share, the rarest of the group first, stands no later in either d than that leaves
    room for. A part is made of the probes and targets that have a shingle so early. All of it is exact.
    """
    k, l = 100 + percent, 100 - percent  # noqa: E741
    pivots = sets.withColumnRenamed("id", "group").join(rest.select("group").distinct(), "group", "left_semi").groupBy("group").agg(F.min("hashes").alias("pivot"))  # one, of ids that repeat too
    both = shared.salted_join(rest.select("group", "id", "component"), pivots, ["group"], hot, F.col("id")).join(sets, "id")
    told = both.select("group", "set", "id", "component", F.concat(F.array_except("hashes", "pivot"), F.array_except("pivot", "hashes")).alias("d"), F.size("hashes").cast("long").alias("size"), (l * F.size("pivot")).cast("long").alias("edge"))
    told = shared.materialize(told.withColumn("excess", k * F.size("d") - l * F.col("size")).drop("size"), "differences")
    at_pivot = told.filter("excess <= edge").select(F.col("id").alias("a"), F.col("group").alias("b"))
    every = told.select("group", "set", F.explode("d").alias("h"))
    usual = shared.materialize(every.groupBy("group", "h").agg(F.count("*").alias("n")).filter("n > 1"), "usual")
    ordered = shared.salted_join(every, usual, ["group", "h"], shared.hot_keys(usual, ["group", "h"], "n"), F.col("set")).groupBy("group", "set").agg(F.array_sort(F.collect_list(F.struct("n", "h"))).alias("own"))
    own = shared.materialize(told.drop("d").join(ordered.withColumn("own", F.col("own.h")), ["group", "set"]), "own")
    early = lambda least: F.explode(F.slice("own", F.lit(1), F.greatest(F.lit(0), F.size("own") + 1 - F.greatest(F.lit(1), F.ceil(least / (2 * k)))).cast("int"))).alias("h")
    targets = own.select("group", "set", "component", F.lit(False).alias("probe"), early(F.col("excess") + F.col("edge") + 1))
    probes = own.filter("excess > edge").select("group", "set", "component", F.lit(True).alias("probe"), early(F.col("excess") - F.col("edge")))
    rows = shared.materialize(targets.union(probes), "parts")
    parts = rows.groupBy("group", "h").agg(F.count_if("probe").alias("probes"), F.count_if(~F.col("probe")).alias("targets"), F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    parts = shared.materialize(parts.filter("probes > 0 AND targets > 0 AND lo <> hi").select("group", "h", "probes", "targets", "n"), "sizes")
    rows = shared.salted_join(rows.drop("component"), parts, ["group", "h"], shared.hot_keys(parts, ["group", "h"], "n"), F.col("set"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("set"), F.when(F.col("probe"), blocks("probes")).otherwise(blocks("targets"))).cast("int")
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("probe"), blocks("targets")).otherwise(blocks("probes")) - 1)))
    at = lambda own, other: F.when(F.col("probe"), F.col(own)).otherwise(F.col(other))
    rows = rows.select("group", "h", at("block", "other").alias("low"), at("other", "block").alias("high"), "set", "probe").join(own.select("group", "set", "id", "component", "excess", "own"), ["group", "set"])
    return rows.groupBy("group", "h", "low", "high").applyInArrow(lambda key, table: _part_links(key, table, percent), _LINK).union(at_pivot)


def _joined(rest: DataFrame, sets: DataFrame, percent: int, levels: int = LEVELS) -> DataFrame:
    """Links (u, v) between different components within the groups of ``rest`` (group, id, component, size)."""
    rest = shared.materialize(rest, "rest")
    sizes = rest.groupBy("group").agg(F.count("*").alias("n"), F.sum("size").alias("volume"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("n > 1 AND lo <> hi").select("group", "n", "volume")
    sizes = shared.materialize(sizes, "sizes")
    hot = shared.hot_keys(sizes, ["group"], "n")
    large = F.col("n") > BLOCK * PARTED
    few, many = (sizes, sizes.limit(0)) if levels < 1 else (sizes.filter(~large), sizes.filter(large))
    links = _in_blocks(shared.salted_join(rest, few, ["group"], hot, F.col("id")), sets, percent)
    if not many.isEmpty():
        links = links.union(_parted(shared.salted_join(rest, many, ["group"], hot, F.col("id")), hot, sets, percent))
    return shared.materialize(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "joined")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts are linked at a similarity of ``percent`` or more; the bands are made for 80 at least.
    A text of fewer than five words has its whole word sequence as one shingle; a null or
    empty text has none and is linked with nothing. Rows that repeat an id are one node:
    a link of any of them holds for all. A null id is never linked; its component is null
    and it is kept. Very long texts are read whole, in one chunk each. An empty table gives no rows. Columns other than doc_id and text are
    not looked at. With ``levels=0`` large groups aren't parted but compared block by block,
    exactly as well, at the square of their size.
    """
    if not 80 <= percent <= 100:
        raise ValueError(f"percent is {percent}, not between 80 and 100")
    shared.bounded_batches(docs.sparkSession)
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    signed = bw.annotate(slim, lambda texts: _sign(texts, percent), "n_shingles long, one long, two long, sig array<int>, keys array<long>", ("doc_id",)).select("row.doc_id", "n_shingles", "one", "two", "sig", "keys")
    signed = shared.materialize(signed, "signed")
    linkable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("one", "two").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    hot_classes = shared.hot_keys(classes, ["one", "two"], "copies")
    of_doc = shared.salted_join(linkable.select("doc_id", "one", "two"), classes, ["one", "two"], hot_classes, F.col("doc_id")).select("doc_id", "rep")
    reps = linkable.join(classes.select("one", "two", F.col("rep").alias("doc_id")), ["one", "two", "doc_id"]).select(F.col("doc_id").alias("id"), "sig", "keys")
    in_bands = reps.select("id", F.explode("keys").alias("key"))
    shared_keys = shared.materialize(in_bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    hot = shared.hot_keys(shared_keys, ["key"], "n")
    members = shared.materialize(shared.salted_join(in_bands, shared_keys, ["key"], hot, F.col("id")), "members")
    central = members.groupBy("id").agg(F.sum("n").alias("weight"))
    candidates = shared.materialize(reps.join(central, "id"), "candidates")

    # a star in each bucket, around the member that shares most
    weighed = members.join(central, "id")
    pivots = weighed.groupBy("key").agg((-F.max(F.struct("weight", -F.col("id")))["col2"]).alias("b"))
    groups = shared.salted_join(members, pivots, ["key"], hot, F.col("id")).select(F.col("b").alias("group"), "id").distinct()
    groups = shared.materialize(groups, "groups")
    star = _close(groups.filter("id <> group").select(F.col("id").alias("a"), F.col("group").alias("b")), candidates)
    wanted = slim.join(candidates.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    sets = shared.materialize(bw.annotate(wanted, _sets, "hashes array<long>", ("doc_id",)).select(F.col("row.doc_id").alias("id"), F.monotonically_increasing_id().alias("set"), "hashes"), "sets")
    links = shared.materialize(_confirmed(star, sets, percent), "links")
    first = components(links)

    # groups that still hold several components
    labelled = groups.join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("group").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).filter("lo <> hi").select("group", "n")
    mixed = shared.materialize(mixed, "mixed")
    rest = shared.salted_join(labelled, mixed.select("group"), ["group"], shared.hot_keys(mixed, ["group"], "n"), F.col("id"))
    here = sets.join(rest.select("id").distinct(), "id").select("id", F.size("hashes").alias("size"), "hashes")
    single = here.select("id", F.explode("hashes").alias("h")).groupBy("h").agg(F.count("*").alias("df"), F.min("id").alias("id")).filter("df = 1").groupBy("id").agg(F.count("*").alias("alone"))
    bounds = here.groupBy("id").agg(F.sum("size").alias("size"), F.count("*").alias("texts")).join(single, "id", "left")
    bounds = bounds.filter((F.col("texts") > 1) | (100 * (F.col("size") - F.coalesce("alone", F.lit(0))) >= percent * F.col("size")))  # a set that shares too little with all others is linked with none
    links = links.union(_joined(rest.join(bounds.select("id", "size"), "id").select("group", "id", "component", "size"), sets, percent, levels))
    labels = components(links)

    placed = of_doc.join(labels, of_doc["rep"] == labels["id"], "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    least = placed.groupBy("doc_id").agg(F.min("component").alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(least, "doc_id", "left")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id")).withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document stands for its group, with their columns as they were."""
    gone = near_duplicates(docs, percent).filter("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(shared.read(spark, sf_dir, "documents"))
