"""Crawls of several pages, read up to where each of them ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.session import working_folder
from sluicework.sources import mappings, paging
from workload import oracle
from workload.registry import query
from workload.tables import Tables

CRAWLS, LIMIT = 23, 3
# What the pages say: every third crawl has an empty page, totals and last tokens differ by crawl.
_EMPTY = "crawl % 3 = 0 AND page = 4"
_TOTAL = "crawl % 7 * 15 + 20"
_LAST = "page >= 2 + crawl % 5"


def _crawls(t: Tables) -> DataFrame:
    """One envelope a page, with all records of its crawl and year."""
    rows = t.feed.filter("feed = 'theirstack'").withColumns({"crawl": F.col("k") % CRAWLS, "page": F.year("o_orderdate") - 1991})
    item = F.struct(F.col("k").cast("string").alias("id"), F.col("title").alias("job_title"), F.col("description"))
    pages = rows.groupBy("crawl", "page").agg(F.collect_list(item).alias("data"))
    data = F.when(F.expr(_EMPTY), F.slice("data", 1, 0)).otherwise(F.col("data"))
    more = F.struct(F.when(F.expr(_LAST), F.lit(None)).otherwise(F.concat_ws("-", "crawl", "page")).alias("token"))
    envelope = F.struct(data.alias("data"), F.expr(_TOTAL).alias("total"), more.alias("next"))
    return pages.select("crawl", "page", F.to_json(envelope).alias("value"))


def _landing(t: Tables) -> str:
    return t.stored("landing_crawls", lambda: _crawls(t), "text", "crawl", "page")


def _mapped(envelopes: DataFrame) -> DataFrame:
    """The records of the envelopes as Bronze rows, with their crawl and page."""
    source = mappings.sources()["theirstack"]
    read = F.from_json("value", source.page_ddl).alias("e")
    by_page = F.concat_ws(" ", "crawl", "page").alias("page")
    rows = source.mapping(envelopes.select(by_page, read).select("page", "e.*"))
    place = F.split("page", " ")
    return rows.select("job_id", "title_raw", "job_description_raw", place[0].cast("int").alias("crawl"), place[1].cast("int").alias("page"))


def _sql(ends: str, limit: int | None = None) -> str:
    over = "OVER (PARTITION BY crawl ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND"
    limited = "" if limit is None else f" OR page - first >= {limit}"
    return f"""WITH {oracle.BRONZE},
records AS (SELECT *, (k % {CRAWLS})::INT AS crawl, (year(o_orderdate) - 1991)::INT AS page FROM bronze WHERE feed = 'theirstack'),
sizes AS (SELECT crawl, page, CASE WHEN {_EMPTY} THEN 0 ELSE count(*) END AS n FROM records GROUP BY crawl, page),
places AS (SELECT *, min(page) {over} CURRENT ROW) AS first, row_number() OVER (PARTITION BY crawl ORDER BY page) AS place,
    sum(n) {over} CURRENT ROW) AS sent FROM sizes),
marks AS (SELECT *, n = 0 OR page - first <> place - 1{limited} AS gone, {ends} AS ends FROM places),
kept AS (SELECT crawl, page FROM marks QUALIFY NOT bool_or(gone) {over} CURRENT ROW)
    AND NOT coalesce(bool_or(ends) {over} 1 PRECEDING), false))
SELECT job_id, title_raw, job_description_raw, crawl, page FROM records JOIN kept USING (crawl, page)"""


@query(_sql("false"))
def paging_empty(t: Tables) -> DataFrame:
    """A page without records ends a crawl."""
    return _mapped(paging.read_crawls(t.spark, _landing(t), "data"))


@query(_sql(f"sent >= {_TOTAL}"))
def paging_total(t: Tables) -> DataFrame:
    """So does reaching the total that the pages state."""
    return _mapped(paging.read_crawls(t.spark, _landing(t), "data", "total"))


@query(_sql(_LAST))
def paging_token(t: Tables) -> DataFrame:
    """So does a page without a token for the next one."""
    return _mapped(paging.read_crawls(t.spark, _landing(t), "data", "token", token="next.token"))


@query(_sql("false", LIMIT))
def paging_limit(t: Tables) -> DataFrame:
    """So does the allowed number of pages."""
    return _mapped(paging.read_crawls(t.spark, _landing(t), "data", max_pages=LIMIT))


@query(_sql(_LAST, 5))
def paging_table(t: Tables) -> DataFrame:
    """The same rules over envelopes that are a table already."""
    pages = _crawls(t)
    size = F.expr("json_array_length(get_json_object(value, '$.data'))")
    token = F.get_json_object("value", "$.next.token")
    return _mapped(paging.stop_pages(pages, size, "token", 5, token=token))


@query(_sql(f"sent >= {_TOTAL}"))
def stream_paging(t: Tables) -> DataFrame:
    """Pages as they arrive, each crawl up to its end."""
    folder = f"{working_folder(t.spark)}/paging-{uuid.uuid4().hex}"
    rows = _mapped(paging.stream_crawls(t.spark, _landing(t), "data", "total"))
    run = rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start(f"{folder}/rows")
    run.awaitTermination()
    return t.spark.read.parquet(f"{folder}/rows")
