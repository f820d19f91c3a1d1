"""Bitmaps that tell which keys are surely not in a set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of 64 bits of a bitmap.
WORDS = 1 << 20
BITS = 4


def bitmap_word(keys: list[str], words: int = WORDS) -> Column:
    """The word that stands for a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(words)).cast("int")


def bitmap_bits(keys: list[str]) -> Column:
    """The bits of that word which a key sets: four, or fewer if they meet."""
    code, bits = F.xxhash64(*keys, F.lit(1)), F.lit(0).cast("long")
    for k in range(BITS):
        at = F.shiftright(code, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return bits
