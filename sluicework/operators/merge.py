"""Merging batches into stored tables.

A merge returns the table's next state as a DataFrame; it is written to a new path, never over the files it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.operators.dedup import batch_keys, first_per_key


def merge_upsert(
    target: DataFrame,
    incoming: DataFrame,
    key: str,
    arrival: str | None = "arrival",
    preserve: Sequence[str] = ("created_at", "fetched_at"),
    now: Column | None = None,
    rows: int | None = None,
) -> DataFrame:
    """The target with incoming rows inserted or put in place of the row of the same key.

    Within the batch the first row of a key counts. A replaced row keeps the target's ``preserve`` columns and any that
    the batch lacks; ``updated_at`` becomes ``now``, and so does ``created_at`` of an inserted row. The target is
    filtered by the batch's keys alone; with ``rows``, the counted size of the batch, a small one is broadcast and the
    target is not shuffled.
    """
    now = F.current_timestamp() if now is None else now
    batch = first_per_key(incoming, key, arrival) if arrival else incoming
    keys = batch_keys(incoming, key, rows)
    kept = target.join(keys, key, "left_anti")
    from_target = [c for c in target.columns if c != key and (c in preserve or c not in batch.columns)]
    from_batch = [c for c in target.columns if c in batch.columns and c != key]
    touched = target.select(key, *[F.col(c).alias(f"_old_{c}") for c in from_target], F.lit(True).alias("_hit")).join(
        keys, key, "left_semi"
    )
    paired = batch.select(key, *from_batch).join(touched, key, "left")
    columns = []
    for c in target.columns:
        fresh = F.col(c) if c in from_batch else F.lit(None).cast(target.schema[c].dataType)
        value = F.when(F.col("_hit"), F.col(f"_old_{c}")).otherwise(fresh) if c in from_target else F.col(c)
        if c == "updated_at":
            value = now
        elif c == "created_at":
            value = F.coalesce(value, now)
        columns.append(value.cast(target.schema[c].dataType).alias(c))
    return kept.unionByName(paired.select(*columns))


def missing_stubs(
    companies: DataFrame,
    postings: DataFrame,
    arrival: str = "arrival",
    domain: str = "company_domain",
    name: str = "company_name",
    now: Column | None = None,
) -> DataFrame:
    """A row (domain, name) for each domain that the companies table lacks.

    Within the batch the last name of a domain counts, even a null one. It is found by an aggregate, which combines
    before the shuffle, so a domain with very many postings is no hot key.
    """
    now = F.current_timestamp() if now is None else now
    named = postings.filter(F.col(domain).isNotNull() & (F.col(domain) != ""))
    last = named.groupBy(F.col(domain).alias("domain")).agg(
        F.max(F.struct(F.col(arrival), F.col(name).alias("name")))["name"].alias("name")
    )
    missing = last.join(companies.select("domain"), "domain", "left_anti")
    given = {"domain": F.col("domain"), "name": F.col("name"), "created_at": now, "updated_at": now}
    return missing.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in companies.schema.fields]
    )


def ensure_stubs(
    companies: DataFrame, postings: DataFrame, arrival: str = "arrival", now: Column | None = None
) -> DataFrame:
    """The companies table with ``missing_stubs`` added; known companies stay as they are."""
    return companies.unionByName(missing_stubs(companies, postings, arrival, now=now))


def current_runs(events: DataFrame) -> DataFrame:
    """Current state of each run: the newest event, with the first event's time as ``run_at``."""
    fields = [c for c in events.columns if c not in ("run_id", "event_at")]
    newest = F.max(F.struct("event_at", *fields))
    return (
        events.groupBy("run_id")
        .agg(F.min("event_at").alias("run_at"), newest.alias("_last"))
        .select("run_id", "run_at", *[F.col(f"_last.{c}").alias(c) for c in fields])
    )


def recent_runs(events: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` runs that started last."""
    return current_runs(events).orderBy(F.col("run_at").desc(), F.col("run_id")).limit(n)
