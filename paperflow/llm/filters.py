"""A 64-bit mixing function, and filters of bounded size over 64-bit keys: they let every key through that they were made from, and few others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 26
SHIFTS = (0, 17, 35)
S1, S2, S3 = np.uint64(30), np.uint64(27), np.uint64(31)
C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    with np.errstate(over="ignore"):
        x = x + C1
        x ^= x >> S1
        x *= C2
        x ^= x >> S2
        x *= C3
        x ^= x >> S3
        return x


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, each value once.  For short arrays a sort is faster than the hash table of ``np.unique``."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


class KeyFilter:
    """Bits, a power of two of them, that are set for every key it was made from, and for few others."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        """Where the first bit turns most keys away, only the others are looked at again."""
        out = self._set(keys, SHIFTS[0])
        if 2 * np.count_nonzero(out) > len(keys):
            for shift in SHIFTS[1:]:
                out &= self._set(keys, shift)
            return out
        left = np.flatnonzero(out)
        for shift in SHIFTS[1:]:
            left = left[self._set(keys[left], shift)]
        out[:] = False
        out[left] = True
        return out

    def _set(self, keys: np.ndarray, shift: int) -> np.ndarray:
        at = (keys >> np.uint64(shift) & np.uint64(8 * len(self.bits) - 1)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def key_filter(keys: DataFrame, column: str, bits: int | None = None) -> KeyFilter:
    """The bits are set by an aggregation over blocks of 32,768 bits; what comes to the driver is ``bits`` bits at most."""
    bits = bits or FILTER_BITS
    places = [F.call_function("shiftrightunsigned", F.col(column), F.lit(s)).bitwiseAND(F.lit(bits - 1).cast("long")) for s in SHIFTS]
    one = keys.select(F.explode(F.array(*[p + 1 for p in places])).alias("p"))
    found = one.groupBy(F.bitmap_bucket_number("p").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in found:
        at = (r["block"] - 1) * 4096
        part = np.frombuffer(r["bits"], np.uint8)
        out[at:at + 4096] = part[:len(out) - at]
    return KeyFilter(out)
