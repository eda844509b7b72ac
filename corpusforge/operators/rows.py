"""Row helper shared by the steps that make a costly value and filter on it."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F


def keep_where(df: DataFrame, kept: list, made: Column, condition: Callable[[Column], Column]) -> DataFrame:
    """``kept`` plus the fields of the struct ``made``, where ``condition(made)`` holds.

    A plain filter would be pushed below the projection that makes the value, and the
    costly expression would run twice; as a one-element array it is made once.
    """
    return df.select(*kept, F.inline(F.filter(F.array(made), condition)))
