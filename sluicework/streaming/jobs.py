"""The same operators over files as they arrive."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicework.operators.dedup import filter_new, first_per_key
from sluicework.plans.ingest import Store, land_bronze, load_batch, log_run, log_success
from sluicework.sources.mappings import Source, sources
from sluicework.sources.readers import combine_sources, pages_of, rejects_of, with_arrival


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint; it lives and goes with the checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def ingest_stream(
    spark: SparkSession,
    source: Source,
    landing: str,
    store: Store,
    checkpoint: str,
    fetched_at: Column | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Insert new postings from page files that have not been read yet, then stop.

    Each micro-batch is stored under the stream's id and its own number in overwrite mode: a batch that runs again after
    a failure replaces its own output, and a stream with a new checkpoint over the same store replaces nothing.
    """
    stamp = F.current_timestamp() if fetched_at is None else fetched_at

    def insert(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        run = f"{source.name}-{stream_id(session, checkpoint)}-{number}"
        load_batch(session, land_bronze(session, batch, store, run), store, run)

    reader = spark.readStream.schema(source.page_ddl)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = with_arrival(source.mapping(reader.json(landing)), source).withColumn("fetched_at", stamp)
    return (
        rows.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


FEED_LINES_DDL = "value string, feed string, page int"


def ingest_feeds(
    spark: SparkSession,
    landing: str,
    store: Store,
    checkpoint: str,
    fetched_at: Column | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """All registered sources in one stream, from folders ``feed=<name>/page=<n>`` of JSON lines, then stop.

    Each micro-batch is a run: its new postings, company stubs, what was rejected and why, and the events of the run are
    stored under the stream's id and the batch's number. A batch that runs again replaces its own folders and adds
    its events again; of events with one run id the newest counts. Lines of a feed that is not registered are rejected.
    """
    stamp = F.current_timestamp() if fetched_at is None else fetched_at

    def insert(batch: DataFrame, number: int) -> None:
        session, start = batch.sparkSession, time.monotonic()
        run = f"feeds-{stream_id(session, checkpoint)}-{number}"
        log_run(session, store, run, "running")
        lines = batch.persist()
        try:
            known = sources()
            own = {name: lines.filter(F.col("feed") == name).select("page", "value") for name in known}
            others = lines.filter(~F.coalesce(F.col("feed").isin(*known), F.lit(False)) & (F.trim("value") != ""))
            strange = others.select(F.col("feed").alias("source"), "page", F.lit("unknown feed").alias("reason"), F.col("value").alias("text"), F.lit(1).cast("long").alias("records"))
            left = combine_sources([strange, *(rejects_of(own[name], source) for name, source in known.items())])
            left.write.mode("overwrite").parquet(store.path("rejects", run))
            rows = combine_sources([with_arrival(source.mapping(pages_of(own[name], source)), source) for name, source in known.items()])
            landed = land_bronze(session, rows.withColumn("fetched_at", stamp), store, run)
        finally:
            lines.unpersist()
        load_batch(session, landed, store, run)
        log_success(session, store, run, landed, start)

    reader = spark.readStream.schema(FEED_LINES_DDL)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(landing).writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_rows(rows: DataFrame, key: str, order: str, out: str, checkpoint: str) -> StreamingQuery:
    """The whole first row of each key, in the order of arrival: micro-batch by micro-batch, within one by ``order``.

    A batch keeps one row of each key on the map side, and its keys are held against those of the batches before it, of
    which only the key column is read: no state grows in the stream, and no time limit forgets a key. A batch that runs
    again replaces its own folder. Rows without a key are kept as one key.
    """

    def keep(batch: DataFrame, number: int) -> None:
        first = first_per_key(batch, key, order)
        if number:
            before = batch.sparkSession.read.schema(batch.schema).parquet(*(f"{out}/batch={n}" for n in range(number)))
            first = filter_new(first, before, key)
        first.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drop_repeats(
    rows: DataFrame, key: str, time: str = "posted_at", delay: str = "15 days", spread: Column | None = None
) -> DataFrame:
    """One row of each key within the watermark; the state holds one entry per key and ``delay``.

    The row comes from the first micro-batch that holds the key; which one of that batch is not promised.

    ``spread`` splits hot keys: repeats are dropped per (key, spread) first, so at most one row of each reaches the
    task that owns the key.
    """
    marked = rows.withWatermark(time, delay)
    if spread is not None:
        marked = marked.withColumn("_spread", spread).dropDuplicatesWithinWatermark([key, "_spread"]).drop("_spread")
    return marked.dropDuplicatesWithinWatermark([key])


def weekly_stream(rows: DataFrame, time: str, flag: Column, delay: str = "15 days") -> DataFrame:
    """Counts per week (Monday start) as they grow; weeks older than the watermark are closed."""
    week = F.window(F.col(time), "7 days", startTime="4 days")
    return (
        rows.withWatermark(time, delay)
        .groupBy(week)
        .agg(F.count(F.lit(1)).alias("job_count"), F.count_if(flag).alias("remote_count"))
        .select(F.col("window.start").cast("date").alias("week_start"), "job_count", "remote_count")
    )
