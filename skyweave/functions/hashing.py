"""Reproducible pseudo-random values.

They depend on the row alone, never on partitioning, so samples and splits survive task retries and
give the same rows on any cluster size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_SPACE = 2**32


def row_digest(seed: int, *parts: Column) -> Column:
    """Hex digest of the row identity and a seed."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed))))


def row_bucket(seed: int, *parts: Column) -> Column:
    """Uniform integer in [0, 2^32)."""
    return F.conv(F.substring(row_digest(seed, *parts), 1, 8), 16, 10).cast("bigint")
