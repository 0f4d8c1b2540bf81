"""The string hash behind the bitmap distinct count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier and bitmap size (2^29 bits, 64 MB) of the hash.
HASH_SEED = 61
BITMAP_BITS = 1 << 29


def poly_hash(text: Column, seed: int = HASH_SEED, bits: int = BITMAP_BITS) -> Column:
    """Polynomial hash of a string reduced to ``bits`` (a power of two).

    The mask is applied at every step: that leaves the low bits as they are and keeps
    the running value far from the 64-bit limit, which ANSI arithmetic would reject.
    """
    mask = F.lit(bits - 1).cast("bigint")
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c).cast("bigint"))
    return F.aggregate(
        codes,
        F.lit(0).cast("bigint"),
        lambda acc, code: (acc * seed + code).bitwiseAND(mask),
    )
