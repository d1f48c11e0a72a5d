"""Seeded pseudo-random columns that give the same value on every run.

``rand()`` depends on the partitioning; an md5 of the row key does not, so a
retried task or another cluster size draws the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*parts: Column | str, seed: int | str) -> Column:
    """Hex md5 of the key parts and the seed, joined by ``|``."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in columns], F.lit(str(seed))))


def leading_int(hex_digest: Column) -> Column:
    """First 32 bits of a hex digest as bigint."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("bigint")


def unit_interval(hex_digest: Column) -> Column:
    """First 32 bits of a hex digest, scaled to [0, 1)."""
    return leading_int(hex_digest) / F.lit(4294967296.0)
