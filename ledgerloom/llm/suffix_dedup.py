"""Operator 7, removal of repeated 100-byte strings by prefix-free parsing.

Rolling-hash triggers cut every text into phrases (``phrases``), so that equal windows lie
at equal places of phrases with the same trigger. The parse, one row per phrase, is dealt
by trigger: a phrase seen earlier is repeated as a whole, and the first occurrence of each
distinct phrase enters the dictionary. Only where a trigger has several distinct phrases
is their text fetched and their suffixes sorted; neighbours that share 100 bytes are equal
windows, and the parse tells which of them comes first in the corpus. A trigger with very
many distinct phrases is no group of its own: its windows are dealt by what they say. Texts
travel compressed; what is removed is told by byte ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import shared
from ledgerloom.llm.phrases import WINDOW, parts, phrases

#: Distinct phrases of one trigger that are sorted in one task; the windows of more are dealt by their own bytes.
TOGETHER = 4096
#: Hot triggers that are broadcast (some megabytes); more are joined, the rows of each dealt over SALTS tasks.
FEW_HOT, SALTS = 200_000, 64
#: Windows whose texts are sorted at a time.
SORTED = 1 << 18
#: Bytes of text whose parse is held at a time.
PARSED = 4 << 20
_KINDS = {"route": pa.int64(), "trigger": pa.int64(), "whole": pa.int64(), "key": pa.int64(), "first": pa.int32(), "last": pa.int32(), "place": pa.int32()}


def _table(names: dict, cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, names.values(), strict=True)], names=[*names])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parse, some megabytes of text at a time; what these repeat themselves is marked by place -1 and isn't dealt by trigger."""
    for b in batches:
        keys, got, size = b.column(0).to_numpy(), [], 0
        for row, at, data, offsets in parts(b.column(1)):
            own, first, last, place, trigger, whole = phrases(data, offsets)
            start = offsets[own] - at
            got.append((keys[own + row], first - start, last - start, place - first, trigger.view(np.int64), whole.view(np.int64)))
            size += len(data)
            if size >= PARSED:
                yield _locally_first(got)
                got, size = [], 0
        if got:
            yield _locally_first(got)


def _locally_first(got: list[tuple]) -> pa.RecordBatch:
    key, first, last, place, trigger, whole = (np.concatenate(x) for x in zip(*got, strict=True))
    order = np.lexsort((first, key, whole, trigger))
    key, first, last, place, trigger, whole = (x[order] for x in (key, first, last, place, trigger, whole))
    again = np.concatenate(([False], (trigger[1:] == trigger[:-1]) & (whole[1:] == whole[:-1])))[: len(key)]
    return _table(_KINDS, (np.where(again, key * 0x9E3779B1, trigger), trigger, whole, key, first, last, np.where(again, -1, place)))


_FOUND = {"key": pa.int64(), "first": pa.int32(), "last": pa.int32(), "place": pa.int32(), "trigger": pa.int64()}


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by trigger, phrase and place in the corpus: repeats (place -1) and the phrases whose trigger has others."""
    old = None  # the row before, and whether it is a first one of unknown company
    for b in batches:
        trigger, whole, key, first, last, place = (b.column(n).to_numpy() for n in ("trigger", "whole", "key", "first", "last", "place"))
        if not len(key):
            continue
        local = place < 0
        if local.any():
            yield _table(_FOUND, (key[local], first[local], last[local], place[local], trigger[local]))
            trigger, whole, key, first, last, place = (x[~local] for x in (trigger, whole, key, first, last, place))
            if not len(key):
                continue
        if old is not None:
            trigger, whole, key, first, last, place = (np.concatenate(([o], x)) for o, x in zip(old, (trigger, whole, key, first, last, place), strict=True))
        same = np.concatenate(([False], trigger[1:] == trigger[:-1]))
        again = same & np.concatenate(([False], whole[1:] == whole[:-1]))
        new = np.flatnonzero(~again)
        company = np.zeros(len(new), bool)
        alike = trigger[new[1:]] == trigger[new[:-1]]
        company[1:] |= alike
        company[:-1] |= alike
        told = company.copy()
        if old is not None:  # the row carried over was told with the batch before if it was known to have company then
            again[0] = False
            told[0] &= not old_told
        tail = new[-1]
        old_told = bool(company[-1]) or (old is not None and tail == 0 and old_told)
        old = tuple(x[tail] for x in (trigger, whole, key, first, last, place))
        pick = np.concatenate((new[told], np.flatnonzero(again)))
        yield _table(_FOUND, (key[pick], first[pick], last[pick], np.where(again[pick], -1, place[pick]), trigger[pick]))


def _packed(docs: DataFrame) -> DataFrame:
    """key, compressed UTF-8 text."""

    def pack(batches):
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([press.compress((x.as_py() or "").encode()) for x in b.column(1)], pa.binary())], names=["key", "packed"])

    return docs.select("key", "text").mapInArrow(pack, "key long, packed binary")


_CONTENT = {"trigger": pa.int64(), "key": pa.int64(), "first": pa.int32(), "hot": pa.bool_(), "content": pa.binary()}


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for key, packed, wanted in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            text = zstandard.decompress(packed)
            for w in wanted:
                for col, x in zip(out, (w["trigger"], key, w["first"], w["hot"], text[w["first"] : w["last"] + WINDOW]), strict=True):
                    col.append(x)
        yield _table(_CONTENT, out)


_RANGE = {"key": pa.int64(), "first": pa.int32(), "last": pa.int32()}


def _repeated(key, first, content: list[bytes]) -> pa.RecordBatch:
    """Windows of whole groups of phrases that also stand earlier, as ranges of first bytes."""
    data = np.frombuffer(b"".join(content), np.uint8)
    size = np.array([len(c) for c in content])
    base = np.concatenate(([0], np.cumsum(size)[:-1]))
    n = size - WINDOW + 1
    phrase = np.repeat(np.arange(len(n)), n)
    nth = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
    windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[base[phrase] + nth]
    suffix = np.ascontiguousarray(windows).view(f"S{WINDOW}").ravel()
    order = np.lexsort((first[phrase] + nth, key[phrase]))  # corpus order, kept by the stable sort of the suffixes
    order = order[np.argsort(suffix[order], kind="stable")]
    again = np.concatenate(([False], suffix[order][1:] == suffix[order][:-1]))[: len(order)]
    at = np.sort(order[again])
    if not len(at):
        return _table(_RANGE, ([], [], []))
    edge = np.concatenate(([True], (np.diff(at) != 1) | (phrase[at[1:]] != phrase[at[:-1]]) | (np.diff(nth[at]) != 1)))
    lo = at[edge]
    hi = at[np.concatenate((edge[1:], [True]))]
    return _table(_RANGE, (key[phrase[lo]], first[phrase[lo]] + nth[lo], first[phrase[lo]] + nth[hi]))


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by trigger; whole groups are sorted together, several small ones at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def tell(t: pa.Table) -> pa.RecordBatch:
        return _repeated(t.column("key").to_numpy(), t.column("first").to_numpy().astype(np.int64), t.column("content").to_pylist())

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows * 40 < SORTED:
            continue
        t = pa.Table.from_batches(held)
        trigger = t.column("trigger").to_numpy()
        edges = np.flatnonzero(trigger[1:] != trigger[:-1]) + 1
        at = 0
        for to in edges[np.searchsorted(edges, np.arange(SORTED // 40, t.num_rows, SORTED // 40)).clip(max=max(len(edges) - 1, 0))] if len(edges) else []:
            if to > at:
                yield tell(t.slice(at, to - at))
                at = int(to)
        held, rows = t.slice(at).to_batches(), t.num_rows - at
    if held:
        yield tell(pa.Table.from_batches(held))


def _tagged(wanted: DataFrame, hot: DataFrame, n_hot: int) -> DataFrame:
    """``wanted`` with whether its trigger is hot; no trigger's rows come together in one task."""
    if not n_hot:
        return wanted.withColumn("hot", F.lit(False))
    if n_hot <= FEW_HOT:
        told = wanted.join(F.broadcast(hot), "trigger", "left")
    else:
        salted = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        told = wanted.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, ["trigger", "salt"], "left")
    return told.withColumn("hot", F.coalesce("hot", F.lit(False)))


def _repeated_anywhere(phrases: DataFrame) -> DataFrame:
    """As ``_repeated``, for phrases whose trigger has very many: each window is a row and equal ones are aggregated.

    The first of equal windows is told by a minimum that is combined before the shuffle; the
    others are what is left without the first ones, joined on the place in the corpus, so that
    no window's copies come together in one task.
    """
    nth = F.explode(F.sequence(F.lit(0), F.length("content") - WINDOW)).alias("nth")
    windows = phrases.select("key", "first", "content", nth).select("key", (F.col("first") + F.col("nth")).alias("first"), F.unhex(F.sha2(F.expr(f"substring(content, nth + 1, {WINDOW})"), 256)).alias("window"))
    firsts = windows.groupBy("window").agg(F.min(F.struct("key", "first")).alias("at")).select("at.*")
    return windows.select("key", "first").join(firsts, ["key", "first"], "left_anti").select("key", "first", F.col("first").alias("last"))


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """key, doc_id, text, and whether the keys are numbers of their own: keys are the ids where these are unique and not null, else numbers in the ids' order, nulls last."""
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    odd = slim.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        return slim.withColumn("key", F.col("doc_id")), False
    by = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ordered = slim.repartitionByRange(*by).sortWithinPartitions(*by)
    return shared.materialize(ordered.withColumn("key", F.monotonically_increasing_id()), "ordered"), True


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and spans, kept bytes).

    Null and empty texts have no bytes. Texts shorter than 100 bytes lose nothing; very long
    ones are parsed in parts that share their windows' ends. Rows that
    repeat an id, and null ids, which come last, are separate documents in an order of their
    own. An empty table gives no rows. Columns other than doc_id and text are not looked at.
    """
    keyed, numbered = _keyed(docs)
    ddl = lambda names: ", ".join(f"{n} {t}".replace("int64", "long").replace("int32", "int").replace("bool", "boolean") for n, t in names.items())
    parse = keyed.select("key", "text").mapInArrow(_parse, ddl(_KINDS))
    dealt = parse.repartition("route").sortWithinPartitions("trigger", "whole", "key", "first").drop("route")
    found = shared.materialize(dealt.mapInArrow(_dictionary, ddl(_FOUND)), "found")

    wanted = found.filter("place >= 0")
    hot = shared.materialize(wanted.groupBy("trigger").count().filter(F.col("count") > TOGETHER).select("trigger", F.lit(True).alias("hot")), "hot")
    n_hot = hot.count()
    tagged = _tagged(wanted, hot, n_hot)
    by_doc = tagged.groupBy("key").agg(F.collect_list(F.struct("trigger", "first", "last", "hot")).alias("wanted"))
    texts = _packed(keyed).join(by_doc, "key").select("key", "packed", "wanted").mapInArrow(_contents, ddl(_CONTENT))
    if n_hot:  # read by both ways
        texts = shared.materialize(texts, "texts")
    partial = texts.filter("NOT hot").repartition("trigger").sortWithinPartitions("trigger").mapInArrow(_sort_suffixes, ddl(_RANGE))
    if n_hot:
        partial = partial.union(_repeated_anywhere(texts.filter("hot")))
    partial = shared.materialize(partial, "partial")

    ranges = found.filter("place < 0").select("key", "first", "last").union(partial)
    gone = ranges.groupBy("key").agg(F.collect_list(F.shiftleft(F.col("first").cast("long"), 32) + F.col("last")).alias("gone"))

    def cut(batches):
        for b in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for key, packed, windows in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                text = zstandard.decompress(packed)
                spans = _spans(windows)
                kept, at = [], 0
                for lo, hi in spans:
                    kept.append(text[at:lo])
                    at = hi
                rest = b"".join([*kept, text[at:]])
                row = (key, len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), [x for s in spans for x in s] if keep_text else None, rest if keep_text else None)
                for col, x in zip(out, row, strict=True):
                    col.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    told = _packed(keyed).join(gone, "key", "left").select("key", "packed", "gone").mapInArrow(cut, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary")
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["spans", "kept"] if keep_text else [])]
    if numbered:
        told = told.join(keyed.select("key", "doc_id"), "key")
    else:
        told = told.withColumn("doc_id", F.col("key"))
    return told.select(*cols)


def _spans(windows: list[int] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows of (first << 32 | last)."""
    out: list[tuple[int, int]] = []
    for x in sorted(windows or ()):
        lo, hi = x >> 32, (x & 0xFFFFFFFF) + WINDOW
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(shared.read(spark, sf_dir, "documents"))
