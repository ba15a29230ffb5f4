"""Permutations and picks by hash against plain computations, one value at a time."""

from __future__ import annotations

import math
import struct

import xxhash
from pyspark.sql import functions as F

from ledgerloom.operators import matching as M
from ledgerloom.operators.pools import permuted


def plain_place(i, size, generation):
    half = math.ceil(math.log2(max(size, 2)) / 2)
    mask, wrap = (1 << half) - 1, (1 << 64) - 1
    while True:
        left, right = i >> half, i & mask
        for r in range(4):
            x = (right + generation * 0x9E3779B97F4A7C15 + r * 0x632BE5AB) & wrap
            x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & wrap
            left, right = right, left ^ ((x ^ (x >> 29)) & mask)
        i = (left << half) | right
        if i < size:
            return i


def test_permuted_equals_a_plain_walk(spark):
    rows = [(i, size, g) for size in (1, 2, 3, 10, 64, 65, 200) for g in (0, 1, 5) for i in range(size)]
    got = spark.createDataFrame(rows, "i long, size long, g long").select("i", "size", "g", permuted("i", "size", "g").alias("place")).collect()
    assert {(r.i, r.size, r.g): r.place for r in got} == {x: plain_place(*x) for x in rows}
    for size in (10, 200):
        orders = [[r.place for r in sorted(got) if r.size == size and r.g == g] for g in (0, 1, 5)]
        assert all(sorted(o) == [*range(size)] for o in orders) and len({*map(tuple, orders)}) == 3


def test_dictionary_values_equal_plain_hashes(spark):
    values = ["red", "green", "blue"]

    def plain(key, salt):
        seed = xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
        h = xxhash.xxh64(struct.pack("<i", salt), seed=seed).intdigest()
        return values[(h - (1 << 64) if h >> 63 else h) % 3]

    for salt in (0, 7):
        got = spark.range(-50, 200).select("id", M.from_dictionary(F.col("id"), values, salt).alias("v")).collect()
        assert {r.id: r.v for r in got} == {i: plain(i, salt) for i in range(-50, 200)}
