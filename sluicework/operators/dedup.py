"""Keeping one row per key, and telling new keys from known ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    # The hash settles ties of the order, so a recomputed task picks the same row again.
    window = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*df.columns))
    return df.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") == 1).drop("_place")


def first_per_key(df: DataFrame, key: str | Sequence[str], arrival: str) -> DataFrame:
    """First row of each key in arrival order.

    Spark keeps only the first row of a key on each side of the shuffle (WindowGroupLimit), so a hot key moves one row
    per input partition, not all its copies.
    """
    return _one_per_key(df, key, [F.col(arrival).asc_nulls_last()])


def last_per_key(df: DataFrame, key: str | Sequence[str], arrival: str) -> DataFrame:
    """Last row of each key in arrival order; as safe for hot keys as ``first_per_key``."""
    return _one_per_key(df, key, [F.col(arrival).desc_nulls_last()])


# Batches up to this many rows may have their keys broadcast: some 100 MB on each executor.
SMALL_BATCH = 1_000_000


def batch_keys(incoming: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """Distinct keys of a batch, marked for broadcast when the caller has counted it and found it small."""
    keys = incoming.select(key).distinct()
    return F.broadcast(keys) if rows is not None and rows <= SMALL_BATCH else keys


def filter_new(incoming: DataFrame, target: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """Incoming rows whose key the target lacks; copies within the incoming rows stay.

    Only the target's key column is read. ``rows``, the counted size of the batch, lets a small one visit the target:
    the target's keys are then filtered where they lie, and only the hits are compared with the batch. Without it, or
    for a large batch, both sides are shuffled by key.
    """
    known = target.select(key)
    if rows is not None and rows <= SMALL_BATCH:
        known = known.join(batch_keys(incoming, key, rows), key, "left_semi")
    return incoming.join(known, key, "left_anti")


def known_rows(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key the target holds (the skipped ones)."""
    return incoming.join(target.select(key), key, "left_semi")


def existing_keys(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Distinct keys that incoming rows and the target share."""
    return incoming.select(key).distinct().join(target.select(key), key, "left_semi")


def dedup_counts(incoming: DataFrame, target: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """One row: incoming, new (distinct keys), duplicate (further copies of new keys) and skipped rows.

    Copies are counted before the join, so a hot key is one row there. ``rows``, the counted size of the batch, lets a
    small one visit the target, whose keys are then not shuffled but for the hits.
    """
    copies = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = target.select(key)
    if rows is not None and rows <= SMALL_BATCH:
        known = known.join(batch_keys(incoming, key, rows), key, "left_semi")
    flagged = copies.join(known.withColumn("known", F.lit(True)), key, "left")
    is_new = F.col("known").isNull()
    return flagged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("incoming"),
        F.count_if(is_new).alias("new"),
        F.coalesce(F.sum(F.when(is_new, F.col("n") - 1)), F.lit(0)).alias("duplicate"),
        F.coalesce(F.sum(F.when(~is_new, F.col("n"))), F.lit(0)).alias("skipped"),
    )
