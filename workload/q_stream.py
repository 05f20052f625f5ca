"""Streaming jobs over the event table and landed pages, read as files arrive."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.operators import merge
from sluicework.operators.dedup import last_per_key
from sluicework.plans import ingest, parts
from sluicework.plans.ingest import Store
from sluicework.session import working_folder
from sluicework.sources.mappings import sources
from sluicework.streaming import jobs
from workload import oracle, q_gold  # noqa: F401
from workload.q_sources import SILVER_OUT, payload, planted, silver_output
from workload.registry import ORACLES, query
from workload.tables import Tables


def _events(t: Tables) -> DataFrame:
    schema = t.events.schema
    files = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    return files.withColumn("ts", F.col("ts").cast("timestamp"))


def _fresh(t: Tables, name: str) -> str:
    return f"{working_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start, count(*) AS job_count, "
    "count(*) FILTER (WHERE event_type = 'signup') AS remote_count FROM events GROUP BY 1"
)
def stream_weekly_counts(t: Tables) -> DataFrame:
    """Weeks in update mode: each batch appends the weeks it changed, and the last state of a week is read."""
    out = _fresh(t, "weeks")

    def append(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/n={number}")

    weeks = jobs.weekly_stream(_events(t), "ts", F.col("event_type") == "signup")
    run = (
        weeks.writeStream.outputMode("update")
        .foreachBatch(append)
        .option("checkpointLocation", _fresh(t, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    states = t.spark.read.parquet(out)
    last = last_per_key(states, "week_start", "batch")
    return last.select(F.col("week_start").cast("string").alias("week_start"), "job_count", "remote_count")


@query("SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts) FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1")
def stream_drop_repeats(t: Tables) -> DataFrame:
    """The whole first event of each user, over events that arrive in many files, in their order."""
    landing, folder = _fresh(t, "events"), _fresh(t, "first")
    parts = [(i, f"{landing}/{i:02d}") for i in range(3)]
    cut = t.events.agg((F.max("event_id") / len(parts) + 1).cast("long")).first()[0]
    for i, path in parts:
        t.events.filter((F.col("event_id") / cut).cast("int") == i).coalesce(1).write.parquet(path)
    rows = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
    jobs.first_rows(rows, "user_id", "event_id", folder, _fresh(t, "checkpoint")).awaitTermination()
    return t.spark.read.schema(t.events.schema).parquet(f"{folder}/*").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT DISTINCT user_id FROM events")
def stream_drop_within(t: Tables) -> DataFrame:
    """Users within the watermark, which here spans the whole table: bounded state, any of a key's rows."""
    out = _fresh(t, "first")
    spread = F.pmod(F.col("event_id"), F.lit(16))
    rows = jobs.drop_repeats(_events(t), "user_id", "ts", "60 days", spread)
    run = (
        rows.select("user_id")
        .writeStream.format("parquet")
        .option("checkpointLocation", _fresh(t, "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    run.awaitTermination()
    return t.spark.read.parquet(out)


def _feeds(t: Tables) -> DataFrame:
    """Lines of all feeds, with lines among those of one that must be rejected."""
    own = {name: (planted(t) if name == "theirstack" else payload(t, name)) for name in sources()}
    parts = [rows.select(F.lit(name).alias("feed"), F.col("page").cast("int").alias("page"), "value") for name, rows in own.items()]
    return reduce(DataFrame.unionByName, parts)


# Stores that a job has filled, per (application, input folder, job): several queries look at one.
_STORES: dict[tuple[str, str, str], Store] = {}


def _store(t: Tables, job: Callable[[Tables], Store]) -> Store:
    key = (t.spark.sparkContext.applicationId, t.folder, job.__name__)
    if key not in _STORES:
        _STORES[key] = job(t)
    return _STORES[key]


def _ingested(t: Tables) -> Store:
    landing = t.stored("landing_feeds", lambda: _feeds(t).repartition(8, "feed", "page"), "text", "feed", "page")
    store = Store(_fresh(t, "store"))
    jobs.ingest_feeds(t.spark, landing, store, _fresh(t, "checkpoint"), t.as_of, max_files=12).awaitTermination()
    return store


@query(f"WITH {oracle.SILVER} SELECT {SILVER_OUT} FROM silver")
def stream_ingest(t: Tables) -> DataFrame:
    """Landed pages of all four feeds to stored Silver rows, in micro-batches."""
    return silver_output(_store(t, _ingested).postings(t.spark))


_REJECTED = "(SELECT count(*) FROM nation) + (SELECT count(*) FROM region) + (SELECT count(*) FROM supplier)"


@query(f"SELECT count(*) AS jobs_fetched, count(*) AS jobs_new, 0 AS jobs_skipped, {_REJECTED} AS jobs_rejected FROM orders")
def stream_ingest_counts(t: Tables) -> DataFrame:
    """What the runs of that stream counted, over all micro-batches."""
    store = _store(t, _ingested)
    runs = merge.current_runs(store.run_events(t.spark)).filter("status = 'success'")
    return runs.agg(*(F.sum(c).alias(c) for c in ("jobs_fetched", "jobs_new", "jobs_skipped", "jobs_rejected")))


def _two_runs(t: Tables) -> Store:
    paths = {name: t.stored(f"landing_{name}", lambda n=name: payload(t, n), "text", "page") for name in sources()}
    store = Store(_fresh(t, "store"))
    ingest.run_ingest(t.spark, paths, store, fetched_at=t.as_of, max_pages=3, run="first")
    ingest.run_ingest(t.spark, paths, store, fetched_at=t.as_of, run="second")
    return store


@query(
    f"WITH {oracle.SILVER} SELECT {SILVER_OUT}, CASE WHEN year(o_orderdate) - 1991 <= 3 THEN 'first' ELSE 'second' END AS run FROM silver"
)
def run_ingest(t: Tables) -> DataFrame:
    """The incremental job from landed pages to stored postings: some pages in one run, all of them in the next."""
    rows = _store(t, _two_runs).postings(t.spark)
    return silver_output(rows, "ingest_run").withColumnRenamed("ingest_run", "run")


@query(
    "SELECT run, 'success' AS status, jobs_fetched, jobs_new, jobs_fetched - jobs_new AS jobs_skipped, 0 AS jobs_rejected FROM "
    "(SELECT 'first' AS run, count(*) FILTER (WHERE year(o_orderdate) - 1991 <= 3) AS jobs_fetched, jobs_fetched AS jobs_new FROM orders "
    "UNION ALL SELECT 'second', count(*), count(*) FILTER (WHERE year(o_orderdate) - 1991 > 3) FROM orders)"
)
def run_ingest_events(t: Tables) -> DataFrame:
    """What these runs logged."""
    runs = merge.current_runs(_store(t, _two_runs).run_events(t.spark))
    return runs.select(F.col("run_id").alias("run"), "status", "jobs_fetched", "jobs_new", "jobs_skipped", "jobs_rejected")


def _from_parts(t: Tables) -> Store:
    store = _store(t, _two_runs)
    for run in ("first", "second"):
        parts.add_run(t.spark, store, run)
    return store


@query(ORACLES["province_stats"])
def province_stats_from_parts(t: Tables) -> DataFrame:
    """Province statistics from the sums that two runs stored."""
    return parts.province_stats(t.spark, _store(t, _from_parts))


@query(ORACLES["weekly_trends"])
def weekly_trends_from_parts(t: Tables) -> DataFrame:
    """Postings per week from the counts that two runs stored."""
    return parts.weekly_trends(t.spark, _store(t, _from_parts)).withColumn("week_start", F.col("week_start").cast("string"))


@query(ORACLES["overview_kpis"])
def overview_kpis_from_parts(t: Tables) -> DataFrame:
    """Key figures from the counts by company that two runs stored."""
    return parts.overview_kpis(t.spark, _store(t, _from_parts))
