"""Reproducible pseudo-random order: the same key always gets the same 60-bit number.

Unlike ``rand`` or ``randomSplit`` the result does not depend on partitioning, task retries or
lost executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
HASH_RANGE = 1 << HASH_BITS


def hash60(key: Column, salt: str = "") -> Column:
    text = key.cast("string")
    if salt:
        text = F.concat(F.lit(salt + "|"), text)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def hash_fold(key: Column, folds: int, salt: str = "") -> Column:
    """Fold number 0..folds-1; a narrow projection."""
    return F.pmod(hash60(key, salt), F.lit(folds)).cast("int")


def hash_below(key: Column, share: float, salt: str = "") -> Column:
    """True for a reproducible ``share`` of the keys."""
    return hash60(key, salt) < F.lit(int(share * HASH_RANGE))
