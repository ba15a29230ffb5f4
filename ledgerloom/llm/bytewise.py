"""Vectorised helpers on the UTF-8 bytes of Arrow string columns (numpy inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import shared

U64 = np.uint64
#: Bytes whose words are hashed together.
_HASHED = 1 << 18
#: Odd multipliers of the polynomial hashes (mod 2**64); their inverses divide a power out again.
BASE = 0x9E3779B97F4A7C15
SEQ = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

#: Bytes below 0x80 folded to lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: White space is \x20 and \x09-\x0D, all else belongs to a word.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: ASCII letters and digits and every byte from 0x80 belong to a word.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Chunk:
    """Some consecutive rows: ``data[offsets[i]:offsets[i + 1]]`` are the bytes of row ``first + i``."""

    first: int
    offsets: np.ndarray
    data: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def chunks(texts: pa.Array, most: int = 1 << 20) -> Iterator[Chunk]:
    """Cut a string column into chunks of about ``most`` bytes; null counts as empty; a long row is a chunk alone."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield Chunk(at, offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]])
        at = to


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` mod 2**64 for i < n."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        got = (np.cumprod(up), np.cumprod(down))
        if size <= 1 << 20:
            _powers[base] = got
    return got[0][:n], got[1][:n]


def prefix_hash(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of ``values[i] * base**i`` (one longer than ``values``) and the inverse powers."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values.astype(U64) * up[:-1], out=sums[1:])
    return sums, down


def span_hash(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each ``values[start:end]``; equal contents hash alike wherever they stand."""
    sums, down = prefix
    return (sums[end] - sums[start]) * down[start]


@dataclass
class Words:
    """Words of a chunk: byte spans, folded hashes, and the first word of each row (one longer than the rows)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    folded: np.ndarray


def words(chunk: Chunk, alphabet: np.ndarray) -> Words:
    """Maximal runs of ``alphabet`` within rows, A-Z folded to a-z before hashing."""
    inside = alphabet[chunk.data]
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    row_edge = np.zeros(len(inside) + 1, bool)
    row_edge[chunk.offsets] = True
    now = np.zeros(len(inside) + 1, bool)
    now[:-1] = inside
    start = np.flatnonzero(now & (~before | row_edge))
    end = np.flatnonzero(before & (~now | row_edge))
    folded = LOWER[chunk.data]
    h, at = np.empty(len(start), U64), 0
    while at < len(start):  # some hundred kilobytes at a time, or one longer word
        to = max(at + 1, int(np.searchsorted(end, start[at] + _HASHED, side="right")))
        lo, hi = start[at], end[to - 1]
        h[at:to] = span_hash(prefix_hash(folded[lo:hi].astype(U64) + U64(1), BASE), start[at:to] - lo, end[at:to] - lo)
        at = to
    h = mix64(h + (end - start).astype(U64))
    return Words(start, end, h, np.searchsorted(start, chunk.offsets), folded)


def told_by(fn, fields: str, text: Column) -> Column:
    """A column of struct ``fields`` (a DDL string), ``fn(texts) -> one Arrow array per field`` over batches of ``text``.

    Only the texts go to the Python workers, and only the fields come back.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    own = T.StructType.fromDDL(fields)
    arrow = list(to_arrow_schema(own))

    def run(texts: pa.Array) -> pa.Array:
        made = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) and x.type == f.type else pa.array(x, type=f.type) for x, f in zip(fn(texts), arrow, strict=True)]
        return pa.StructArray.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in made], fields=arrow)

    return F.arrow_udf(run, own).asNondeterministic()(text.cast("string"))  # told once for each row, wherever its fields are used


def annotate(docs: DataFrame, fn, fields: str, keep: tuple[str, ...] | None = None, text: str = "text") -> DataFrame:
    """``row`` (a struct of the columns ``keep``, all where None) of every row and the fields that ``told_by`` tells.

    Names of the caller's columns can't clash with ``fields``.
    """
    shared.bounded_batches(docs.sparkSession)
    row = F.struct("*") if keep is None else F.struct(*[docs[c] for c in keep])
    return docs.select(row.alias("row"), told_by(fn, fields, docs[text]).alias("told")).select("row", "told.*")


def where(docs: DataFrame, fn, text: str = "text") -> DataFrame:
    """The rows of ``docs`` for whose texts ``fn(texts)`` is true."""
    shared.bounded_batches(docs.sparkSession)
    return docs.filter(told_by(lambda texts: [fn(texts)], "yes boolean", docs[text])["yes"])
