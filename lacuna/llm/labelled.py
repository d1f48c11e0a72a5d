"""Bounded samples of labelled documents for fitting, and the split that keeps rows out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 4000
SAMPLE_BYTES = 1 << 16


def remainder(row_id: str, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo ``divisor``; a null id gives 0 or more too."""
    return F.coalesce(F.crc32(F.col(row_id).cast("string").cast("binary")), F.lit(0)) % divisor


def sample(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, rows: int = SAMPLE_ROWS,
           max_bytes: int = SAMPLE_BYTES, text: str = "text", row_id: str = "doc_id") -> tuple[pa.Array, np.ndarray]:
    """Texts and 0/1 labels of at most ``rows`` labelled documents, chosen by a hash of
    the id; whole texts of more than ``max_bytes`` bytes are no part of the sample.

    ``learnable`` is a condition on ``labels``; null labels and ids are left out.  The
    chosen ids, at most ``rows``, are broadcast to the scan of ``docs``.
    """
    known = labels.where(learnable & F.col(row_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(row_id).cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    own = docs.select(F.col(row_id).cast("long").alias("id"), F.col(text).alias("x"))
    own = own.where(F.octet_length("x").between(0, max_bytes))
    table = own.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), F.xxhash64("x")).limit(rows)
    table = table.select("x", "y").toArrow()
    return table["x"].combine_chunks(), table["y"].to_numpy().astype(np.float64)
