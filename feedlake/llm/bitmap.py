"""A bitmap of hashes: a filter of fixed size that runs ahead of an exact join.

Its size is a parameter and does not grow with the data. A fuller bitmap lets more rows through to
the join, which decides alone; it never drops a row that has a partner.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^24 bits are 2 MB in every task.
BITS = 24


def bitmap(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The bitmap of a bigint column, as 64-bit words; at most 2^bits / 64 of them reach the driver."""
    place = F.col(column).bitwiseAND((1 << bits) - 1)
    filled = (
        df.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(63).alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("mask"))
        .toArrow()
    )
    words = np.zeros((1 << bits) // 64, np.uint64)
    words[filled["word"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64)
    return words


def may_hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the 64-bit hashes may be in the bitmap."""
    place = hashes & np.uint64(len(words) * 64 - 1)
    return (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def text_hash(column: str = "text") -> Column:
    """What stands for a whole text in joins; null for a null text."""
    return F.md5(F.col(column).cast("binary"))
