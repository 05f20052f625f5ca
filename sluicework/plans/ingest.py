"""The incremental job (landed pages to stored tables) and the backfill job.

Stored tables grow by one folder per run. A run only inserts postings whose key is new, so the large table is never
rewritten: its key column is read, nothing else. A folder is written in overwrite mode, so a run that is repeated after
a failure replaces its own half-written output.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework import schemas
from sluicework.operators.dedup import dedup_counts, filter_new, first_per_key
from sluicework.operators.joins import fill_from
from sluicework.operators.keyed import KeyedTable
from sluicework.operators.merge import missing_stubs
from sluicework.plans.silver import bronze_fallback, to_silver
from sluicework.sources.mappings import sources
from sluicework.sources.readers import REJECTS_DDL, ingest_bronze, read_rejects

ARRIVAL_DDL = "arrival struct<source_rank: int, page: int, pos: int>"
POSTINGS_DDL = (
    f"{schemas.BRONZE_DDL}, source string, {ARRIVAL_DDL}, fetched_at timestamp, {schemas.SILVER_DDL}, filled boolean, "
    "created_at timestamp, updated_at timestamp, ingest_run string"
)


@dataclass(frozen=True)
class Store:
    """Places of the stored tables."""

    root: str

    def path(self, table: str, run: str | None = None) -> str:
        return f"{self.root}/{table}" + (f"/ingest_run={run}" if run else "")

    def read(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        """A table, empty before its first run. The schema is given, so no file is opened to find it."""
        try:
            return spark.read.schema(ddl).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], ddl)

    def postings(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "postings", POSTINGS_DDL)

    def companies(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "companies", f"{schemas.COMPANIES_DDL}, ingest_run string")

    def rejects(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "rejects", f"{REJECTS_DDL}, ingest_run string")

    def run_events(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "runs", schemas.RUN_EVENTS_DDL)


def log_run(spark: SparkSession, store: Store, run: str, status: str, **fields: object) -> None:
    """Append one event of a run: its start, or its end with counts."""
    names = [part.strip().split(" ")[0] for part in schemas.RUN_EVENTS_DDL.split(",")]
    types = [part.strip().split(" ")[1] for part in schemas.RUN_EVENTS_DDL.split(",")]
    values = {"run_id": F.lit(run), "event_at": F.current_timestamp(), "status": F.lit(status)}
    columns = [
        values.get(n, F.lit(fields.get(n))).cast(kind).alias(n) for n, kind in zip(names, types)
    ]
    spark.range(1).select(*columns).coalesce(1).write.mode("append").parquet(store.path("runs"))


def land_bronze(spark: SparkSession, rows: DataFrame, store: Store, run: str) -> DataFrame:
    """Store a run's Bronze rows, and read them back: the payloads are parsed once."""
    rows.write.mode("overwrite").parquet(store.path("bronze", run))
    return spark.read.parquet(store.path("bronze", run))


def load_batch(
    spark: SparkSession, batch: DataFrame, store: Store, run: str, curated: DataFrame | None = None
) -> None:
    """Bronze rows to Silver rows with new keys, stored as the run's folder, then stubs for companies not yet known.

    ``batch`` is a stored table, so counting it reads file footers only.
    """
    known = store.postings(spark).filter(F.col("ingest_run") != run)
    fresh = filter_new(first_per_key(batch, "job_id", "arrival"), known, "job_id", rows=batch.count())
    silver = to_silver(fresh)
    if curated is None:
        silver = silver.withColumn("filled", F.lit(False))
    else:
        fields = [c for c in curated.columns if c != "job_id"]
        silver = fill_from(silver, curated, "job_id", fields)
    now = F.current_timestamp()
    silver.withColumns({"created_at": now, "updated_at": now}).write.mode("overwrite").parquet(
        store.path("postings", run)
    )
    stored = store.postings(spark).filter(F.col("ingest_run") == run)
    others = store.companies(spark).filter(F.col("ingest_run") != run).drop("ingest_run")
    missing_stubs(others, stored).write.mode("overwrite").parquet(store.path("companies", run))


def log_success(spark: SparkSession, store: Store, run: str, batch: DataFrame, start: float) -> None:
    """Append the event of a finished run, with its counts; ``start`` is the clock's reading when it began."""
    before = store.postings(spark).filter(F.col("ingest_run") != run)
    counts = dedup_counts(batch, before, "job_id", rows=batch.count()).first()
    rejected = store.rejects(spark).filter(F.col("ingest_run") == run).agg(F.sum("records")).first()[0]
    log_run(
        spark,
        store,
        run,
        "success",
        jobs_fetched=counts["incoming"],
        jobs_new=counts["new"],
        jobs_skipped=counts["skipped"],
        jobs_duplicate=counts["duplicate"],
        companies_added=store.companies(spark).filter(F.col("ingest_run") == run).count(),
        duration_seconds=round(time.monotonic() - start, 2),
        jobs_rejected=rejected or 0,
    )


def run_ingest(
    spark: SparkSession,
    paths: Mapping[str, str],
    store: Store,
    curated: DataFrame | None = None,
    fetched_at: Column | None = None,
    max_pages: int | None = None,
    run: str | None = None,
) -> str:
    """One run: land Bronze, insert new postings, add company stubs, log counts. Returns the run's id.

    What cannot be taken from the landed pages is stored with its reason beside Bronze, source by source, before the
    rows are landed; a source whose files cannot be read fails there and is skipped. Records landed = fetched + rejected.
    """
    run = run or uuid.uuid4().hex
    start = time.monotonic()
    log_run(spark, store, run, "running")
    try:

        def keep_rejects(name: str, feed: DataFrame) -> None:
            left = read_rejects(spark, paths[name], sources()[name], max_pages)
            # The source is a folder of its own within the run, so that a run that is repeated replaces it.
            left.write.mode("overwrite").parquet(f"{store.path('rejects', run)}/feed={name}")

        landed = ingest_bronze(spark, paths, fetched_at, max_pages, keep_rejects)
        batch = land_bronze(spark, landed, store, run)
        load_batch(spark, batch, store, run, curated)
        log_success(spark, store, run, batch, start)
    except Exception as error:
        took = round(time.monotonic() - start, 2)
        log_run(spark, store, run, "failed", error_message=str(error), duration_seconds=took)
        raise
    return run


LATEST_DDL = POSTINGS_DDL.replace(", ingest_run string", "")


def latest_table(store: Store, parts: int = 64) -> KeyedTable:
    """The store's table of the latest state of every posting."""
    return KeyedTable(store.path("latest"), LATEST_DDL, "job_id", parts)


def refresh_latest(spark: SparkSession, store: Store, run: str, curated: DataFrame | None = None, parts: int = 64) -> list[int]:
    """Merge all Bronze rows of a run into the latest state: new postings are inserted, known ones replaced.

    ``postings`` keeps what a posting was when it was first seen; this table has what it is now. Only the folders of the
    run's keys are read and written; they are returned.
    """
    batch = spark.read.parquet(store.path("bronze", run))
    silver = to_silver(first_per_key(batch, "job_id", "arrival"))
    silver = silver.withColumn("filled", F.lit(False)) if curated is None else fill_from(silver, curated, "job_id", [c for c in curated.columns if c != "job_id"])
    silver.write.mode("overwrite").parquet(store.path("latest_batches", run))
    return latest_table(store, parts).merge(spark.read.parquet(store.path("latest_batches", run)), preserve=("created_at",))


def backfill(spark: SparkSession, source: Store, target: Store) -> None:
    """All stored postings transformed again, written to another store; relative dates keep their fetch time."""
    rows = bronze_fallback(source.postings(spark))
    silver = to_silver(rows).withColumn("updated_at", F.current_timestamp())
    silver.write.mode("overwrite").partitionBy("ingest_run").parquet(target.path("postings"))
