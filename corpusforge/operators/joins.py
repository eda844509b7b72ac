"""Joins with a key table whose size is measured first."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

#: A key table is broadcast up to this many rows and bytes of its text columns; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def is_small(keys: DataFrame) -> bool:
    """Does a written table fit the bounds of a broadcast?"""
    return fits(keys, BROADCAST_ROWS, BROADCAST_BYTES)


def fits(keys: DataFrame, most_rows: int, most_bytes: int) -> bool:
    """Has a written table no more rows and bytes?  Its rows and their text are counted, not estimated."""
    texts = [name for name, kind in keys.dtypes if kind == "string"]
    size = sum((F.coalesce(F.octet_length(name), F.lit(0)) for name in texts), F.lit(16))
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return rows <= most_rows and total <= most_bytes


def semi_or_anti(df: DataFrame, keys: DataFrame, on: str | Sequence[str], how: str) -> DataFrame:
    """``df`` joined with a written table of distinct keys, which is broadcast if it is small."""
    return df.join(F.broadcast(keys) if is_small(keys) else keys, [on] if isinstance(on, str) else list(on), how)
