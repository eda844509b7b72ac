"""Fetched page snapshots ``(url, html, status, fetched_at)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.dedup import latest_rows


def successful(snapshots: DataFrame) -> DataFrame:
    """Only pages that arrived, with a body."""
    return snapshots.where((F.col("status") == 200) & (F.col("html") != ""))


def newest_pages(snapshots: DataFrame) -> DataFrame:
    """One page per URL, the last one fetched."""
    return latest_rows(snapshots, "url", "fetched_at")


def fresh(snapshots: DataFrame, now, hours: int = 24) -> DataFrame:
    """Stored pages that have not expired at ``now`` (a timestamp literal or column)."""
    now = F.to_timestamp(F.lit(now)) if isinstance(now, str) else now
    limit = now - F.make_interval(hours=F.lit(hours))
    return snapshots.where((F.col("status") == 200) & (F.col("fetched_at") > limit))


def urls_to_fetch(urls: DataFrame, snapshots: DataFrame, now, hours: int = 24) -> DataFrame:
    """URLs without an unexpired page; only the URL column of the snapshots is read."""
    known = fresh(snapshots, now, hours).select("url").distinct()
    return urls.join(known, "url", "left_anti")


def servable_pages(urls: DataFrame, snapshots: DataFrame, now, hours: int = 24) -> DataFrame:
    """The newest unexpired page of each wanted URL."""
    wanted = fresh(snapshots, now, hours).join(urls.select("url"), "url", "left_semi")
    return newest_pages(wanted)
