"""A reproducible shuffle whose shard and slot can be computed for any row number.

Rows are numbered 0..n-1 in ascending id order (ties by text). A Feistel network over the smallest
rectangle that holds n permutes the numbers; a result of n or more is permuted again until it falls
below n (cycle walking), which keeps it a permutation of 0..n-1. Position p is slot p div S of shard
p mod S, so shard counts differ by at most one (law `rows`) and no table is needed to find a row.

Defined results: NULL text has 16 bytes of size and the CRC of no bytes; rows with NULL ids are numbered
first; repeated rows are separate rows; an empty table gives no row. Equal texts are not kept together:
the law of equal counts cannot hold with groups of any size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_start

ROUNDS = 6


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers (multiply and fold)."""
    x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permuted(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Where each number below n lands; a permutation of 0..n-1 for every n and seed."""
    if n <= 1:
        return np.zeros_like(numbers)
    a = int(np.ceil(np.sqrt(n)))
    b = -(-n // a)
    keys = [int(k) for k in np.random.default_rng(seed).integers(0, 2 ** 62, ROUNDS)]
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] // np.uint64(b), out[walking] % np.uint64(b)
        for i, key in enumerate(keys):  # the halves take turns: each is shifted by a mix of the other
            if i % 2:
                right = (right + _mixed(left, key) % np.uint64(b)) % np.uint64(b)
            else:
                left = (left + _mixed(right, key) % np.uint64(a)) % np.uint64(a)
        out[walking] = left * np.uint64(b) + right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def shard(df: DataFrame, shards: int, order: list[str], seed: int = 20240601) -> DataFrame:
    """Adds `row`, `shard` and `slot` to every row of a table."""
    numbered = running_start(df, order, {"row": F.lit(1).cast("long")})
    n = df.count()

    @F.pandas_udf("long")
    def position(row: pd.Series) -> pd.Series:
        return pd.Series(permuted(row.to_numpy(np.int64), n, seed))

    return (numbered.withColumn("__at", position("row"))
            .withColumn("shard", (F.col("__at") % shards).cast("int"))
            .withColumn("slot", F.expr(f"__at div {shards}"))
            .drop("__at"))
