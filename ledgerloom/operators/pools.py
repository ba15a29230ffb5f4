"""Permutations of pools whose size changes from one generation to the next."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

_ROUNDS = 4


def _permute(i: np.ndarray, size: np.ndarray, generation: np.ndarray) -> np.ndarray:
    """Balanced Feistel rounds on the next even number of bits, walked until the value is below ``size``."""
    half = (np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = i.astype(np.uint64), np.ones(len(i), bool)
    while todo.any():
        left, right, m = out[todo] >> half[todo], out[todo] & mask[todo], mask[todo]
        for r in range(_ROUNDS):
            x = right + generation[todo].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r * 0x632BE5AB)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((x ^ (x >> np.uint64(29))) & m)
        out[todo] = (left << half[todo]) | right
        todo = out >= size.astype(np.uint64)
    return out.astype(np.int64)


def _permuted(i: pd.Series, size: pd.Series, generation: pd.Series) -> pd.Series:
    return pd.Series(_permute(i.to_numpy(), size.to_numpy(), generation.to_numpy()))


def permuted(i: Column | str, size: Column | str, generation: Column | str) -> Column:
    """Where item ``i`` of a pool of ``size`` goes in a generation: a bijection of 0 … size - 1 for each generation.

    The size is a value of the row, so one pass serves pools that grow and shrink; nothing
    is held but the batch at hand. All three are 64-bit numbers without nulls, 0 <= i < size.
    """
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return pandas_udf(_permuted, "long")(c(i).cast("long"), c(size).cast("long"), c(generation).cast("long"))
