"""Reproducible pseudo-random numbers from row keys.

The draw for a row depends only on its key and the seed, so retries, re-runs and other
partitionings give the same sample, and plain SQL can compute the same value.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_RANGE = 1 << 32


def hash32(*parts) -> Column:
    """Uniform integer in [0, 2^32) from the first eight hex digits of an MD5."""
    text = F.concat_ws("-", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p))
                              for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(*parts) -> Column:
    """Uniform double in (0, 1)."""
    return (hash32(*parts) + F.lit(0.5)) / F.lit(float(HASH_RANGE))


def hash32_sql(*parts: str) -> str:
    """The same hash as an SQL expression over SQL expressions."""
    text = " || '-' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


def uniform_sql(*parts: str) -> str:
    return f"(({hash32_sql(*parts)} + 0.5) / 4294967296.0)"
