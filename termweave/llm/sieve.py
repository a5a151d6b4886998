"""A Bloom filter of fixed size: rows that can't meet a table are left out before they are shuffled.

It lets every member through, and other rows the more the larger the table is; what it lets through
is joined exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits: 4 MB, however large the table is.
BITS = 19
_U = np.uint64


class Sieve:
    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def of(table: DataFrame, hash: Column) -> Sieve:
        """Of the hashes' values; the words are made by the tasks, at most 2 ** BITS reach the driver."""
        bits = F.expr("shiftleft(1L, cast(h & 63 as int)) | shiftleft(1L, cast(shiftrightunsigned(h, 6) & 63 as int))")
        word = F.expr(f"cast(shiftrightunsigned(h, {64 - BITS}) as int)")
        rows = table.select(hash.alias("h")).select(word.alias("word"), bits.alias("bits"))
        got = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        words = np.zeros(1 << BITS, np.uint64)
        words[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
        return Sieve(words)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the values with these hashes may be members."""
        h = hashes.view(np.uint64)
        bits = (_U(1) << (h & _U(63))) | (_U(1) << ((h >> _U(6)) & _U(63)))
        return self.words[(h >> _U(64 - BITS)).astype(np.int64)] & bits == bits
