"""MinHash signatures of token arrays with a fixed, seeded hash family."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRIME = 999983


def coefficients(count: int, seed: int = 7) -> list[tuple[int, int]]:
    """``count`` pairs (a, b) below the prime, the same for a seed everywhere."""
    draw = lambda kind, i: int(hashlib.sha256(f"{seed}:{kind}:{i}".encode()).hexdigest()[:12], 16)
    return [(1 + draw("a", i) % (PRIME - 1), draw("b", i) % PRIME) for i in range(count)]


def token_number(token: Column) -> Column:
    """A token's number below the prime, from the first eight hex digits of its MD5."""
    return F.conv(F.substring(F.md5(token.cast("binary")), 1, 8), 16, 10).cast("long") % PRIME


def signature(tokens: Column, count: int = 100, seed: int = 7) -> Column:
    """Least value of every hash function over the tokens; null entries for no tokens."""
    return _least(count, seed)(F.array_compact(F.transform(tokens, token_number)))


def _least(count: int, seed: int):
    """UDF: arrays of numbers to ``count`` least hashes each, a hash function over a whole Arrow batch at a time."""
    pairs = coefficients(count, seed)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def least(numbers: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(numbers), 0).to_numpy(zero_copy_only=False)
        found = np.zeros((len(numbers), count), dtype=np.int64)
        filled = sizes > 0
        if filled.any():
            distinct, at = np.unique(numbers.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            starts = (np.cumsum(sizes) - sizes)[filled]
            for i, (a, b) in enumerate(pairs):
                found[filled, i] = np.minimum.reduceat(((distinct * a + b) % PRIME)[at], starts)
        offsets = np.arange(0, (len(numbers) + 1) * count, count, dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(found.ravel(), mask=np.repeat(~filled, count)))

    return least


def similarity(left: Column, right: Column) -> Column:
    """Share of equal positions of two signatures of one length."""
    same = F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda z: z))
    return F.when(F.size(left) == F.size(right), same / F.size(left)).otherwise(F.raise_error(F.lit("signatures of different lengths")))


def jaccard(left: Column, right: Column) -> Column:
    """Exact Jaccard similarity of two arrays of distinct values."""
    return F.try_divide(F.size(F.array_intersect(left, right)), F.size(F.array_union(left, right)))
