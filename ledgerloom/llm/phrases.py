"""Phrases of byte texts, cut by the smallest rolling hash in every window (numpy inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgerloom.llm import bytewise as bw

WINDOW = 100
#: Length of the trigger strings whose rolling hashes are compared.
TRIGGER = 32
_WIDTH = WINDOW - TRIGGER + 1
_PLACE = 22
_MASK = np.uint64((1 << _PLACE) - 1)
#: Windows of a long text that are looked at together; the next part begins with the next window.
PART = 1 << 18


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, out = 1, x
    while 2 * size <= width:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    return np.minimum(out[: len(x) - width + 1], out[width - size : width - size + len(x) - width + 1])


def phrases(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Every window of WINDOW bytes belongs to the leftmost smallest trigger in it; a trigger's windows make a phrase.

    Returns, by phrase: row, first window, last window, trigger place (all from the start of
    ``data``), hash of the trigger, hash of the bytes that its windows cover and of where
    the trigger stands in them. Equal windows always stand at the same place of phrases
    whose triggers are equal.
    """
    if len(data) < WINDOW:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    prefix = bw.prefix_hash(data.astype(np.uint64) + np.uint64(1), bw.BASE)
    sums, down = prefix
    n = len(data) - TRIGGER + 1
    rolled = bw.mix64((sums[TRIGGER : TRIGGER + n] - sums[:n]) * down[:n])
    order = (rolled & ~_MASK) | np.arange(n, dtype=np.uint64)
    owner = (_sliding_min(order, _WIDTH) & _MASK).astype(np.int64)  # by first byte of the window
    start = np.arange(len(owner))
    row = np.searchsorted(offsets, start, side="right") - 1
    inside = start + WINDOW <= offsets[row + 1]
    start, row, owner = start[inside], row[inside], owner[inside]
    if not len(start):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    edge = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (row[1:] != row[:-1]))))
    last = np.concatenate((edge[1:], [len(start)])) - 1
    first, last, row, place = start[edge], start[last], row[edge], owner[edge]
    whole = bw.mix64(bw.span_hash(prefix, first, last + WINDOW) + (place - first).astype(np.uint64) * np.uint64(bw.SEQ[0]))
    return row, first, last, place, rolled[place], whole


def parts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, byte of that row that ``data`` begins with, data, offsets); long texts come in parts that share WINDOW - 1 bytes."""
    for c in bw.chunks(texts, most=PART):
        if len(c.data) <= PART + WINDOW:
            yield c.first, 0, c.data, c.offsets
            continue
        for at in range(0, max(1, len(c.data) - WINDOW + 1), PART):
            own = c.data[at : at + PART + WINDOW - 1]
            yield c.first, at, own, np.array([0, len(own)])
