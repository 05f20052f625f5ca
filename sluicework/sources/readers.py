"""Reading landed pages and stored tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from sluicework import lookups, schemas
from sluicework.sources.mappings import Source, sources

logger = logging.getLogger(__name__)


def read_pages(spark: SparkSession, path: str, source: Source, max_pages: int | None = None) -> DataFrame:
    """Landed page files of one source (JSON lines, one envelope per line).

    Files lie in ``page=<n>`` folders, so ``max_pages`` skips files instead of reading and dropping them. A folder
    without page numbers is read as page 1.
    """
    pages = spark.read.schema(source.page_ddl).json(path)
    if "page" not in pages.columns:
        pages = pages.withColumn("page", F.lit(1))
    return limit_pages(pages, max_pages)


REJECTS_DDL = "source string, page int, reason string, text string, records long"


def read_rejects(spark: SparkSession, path: str, source: Source, max_pages: int | None = None) -> DataFrame:
    """What ``read_pages`` and the mapping of a source leave out, with its reason.

    A line that is no JSON, or has no array of records (an error message, say), is given as it is and counts as one
    record; of records without an id, their number on each page is given.
    """
    lines = spark.read.text(path)
    if "page" not in lines.columns:
        lines = lines.withColumn("page", F.lit(1))
    return rejects_of(limit_pages(lines, max_pages), source)


def rejects_of(lines: DataFrame, source: Source) -> DataFrame:
    """``read_rejects`` of lines (``page``, ``value``) that are read already."""
    array = next(f.name for f in StructType.fromDDL(source.page_ddl) if isinstance(f.dataType, ArrayType))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    lines = lines.filter(F.trim("value") != "")
    lines = lines.select(F.col("page").cast("int").alias("page"), F.col("value").alias("_line"), _parsed(f"{source.page_ddl}, _corrupt string", options))
    broken, records = F.col("_corrupt").isNotNull(), F.col(array)
    reason = F.when(broken, "broken line").otherwise("no records")
    texts = lines.filter(broken | records.isNull()).select("page", reason.alias("reason"), F.col("_line").alias("text"), F.lit(1).cast("long").alias("records"))
    whole = lines.filter(~broken & records.isNotNull()).drop("_line", "_corrupt")
    sent = whole.groupBy("page").agg(F.sum(F.size(array)).alias("sent"))
    taken = source.mapping(whole).groupBy("page").agg(F.count(F.lit(1)).alias("taken"))
    lost = sent.join(taken, "page", "left").select("page", (F.col("sent") - F.coalesce("taken", F.lit(0))).alias("records"))
    lost = lost.filter("records > 0").select("page", F.lit("no id").alias("reason"), F.lit(None).cast("string").alias("text"), "records")
    return texts.unionByName(lost).select(F.lit(source.name).alias("source"), "page", "reason", "text", "records")


def _parsed(ddl: str, options: Mapping[str, str] | None = None) -> Column:
    """Columns of the envelope in ``value``. As a generator it runs once a line: what is asked of a plain column is asked
    below it too, each time with a parse of its own."""
    return F.inline(F.array(F.from_json("value", ddl, dict(options or {}))))


def pages_of(lines: DataFrame, source: Source) -> DataFrame:
    """Envelopes of lines (``page``, ``value``) that are read already, as ``read_pages`` gives them."""
    return lines.select("page", _parsed(source.page_ddl))


def limit_pages(pages: DataFrame, max_pages: int | None) -> DataFrame:
    """Keep the first ``max_pages`` pages of every crawl."""
    return pages if max_pages is None else pages.filter(F.col("page") <= max_pages)


def with_arrival(mapped: DataFrame, source: Source) -> DataFrame:
    """Add source name and ``arrival``, the order of a record in the combined feed: source, page, place in the page."""
    page = F.col("page") if "page" in mapped.columns else F.lit(1)
    arrival = F.struct(
        F.lit(source.rank).cast("int").alias("source_rank"), page.cast("int").alias("page"), F.col("pos")
    )
    return mapped.select(
        "job_id", *schemas.RAW_FIELDS, F.lit(source.name).alias("source"), arrival.alias("arrival")
    )


def combine_sources(mapped: Sequence[DataFrame]) -> DataFrame:
    """Bag union of mapped sources, by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), mapped)


def ingest_bronze(
    spark: SparkSession,
    paths: Mapping[str, str],
    fetched_at: Column | None = None,
    max_pages: int | None = None,
    check: Callable[[str, DataFrame], object] | None = None,
) -> DataFrame:
    """Bronze rows of all sources that can be read; a source that fails is logged and skipped.

    Without ``check`` only a missing path shows in time. ``check`` gets each source's rows and may run them, so that a
    source with files that cannot be read is skipped too.
    """
    feeds = []
    for name, source in sources().items():
        if name not in paths:
            continue
        try:
            pages = read_pages(spark, paths[name], source, max_pages)
            feed = with_arrival(source.mapping(pages), source)
            if check is not None:
                check(name, feed)
            feeds.append(feed)
        except (PySparkException, Py4JJavaError):
            logger.exception("source %s could not be read; it is skipped", name)
    if not feeds:
        raise ValueError("no source could be read")
    stamp = F.current_timestamp() if fetched_at is None else fetched_at
    return combine_sources(feeds).withColumn("fetched_at", stamp)


def source_of(
    job_id: Column, prefixes: Sequence[str] = tuple(lookups.SOURCE_PREFIXES), default: str = lookups.SOURCE_DEFAULT
) -> Column:
    """Source named by the id's prefix."""
    out = None
    for prefix in prefixes:
        hit = job_id.startswith(f"{prefix}_")
        out = F.when(hit, F.lit(prefix)) if out is None else out.when(hit, F.lit(prefix))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


# A task for each core would leave most idle at the end; some tasks a core even out.
TASKS_A_CORE = 3


def spread(rows: DataFrame, least_rows: int = 1000) -> DataFrame:
    """``rows`` in enough partitions for costly work on each of them.

    A table in few files or row groups is read by few tasks, whatever is then done with its rows. Where there are fewer
    tasks than the cores can take, the rows are dealt out once, at least ``least_rows`` to a task; a table that is
    larger than that is read as it lies. Rows are counted from file footers.
    """
    wanted = TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= wanted:
        return rows
    wanted = min(wanted, rows.count() // least_rows)
    return rows.repartition(wanted) if wanted > 1 else rows


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A stored table, whole or only the named columns (the scan reads no others)."""
    table = spark.read.parquet(path)
    return table if columns is None else table.select(*columns)
