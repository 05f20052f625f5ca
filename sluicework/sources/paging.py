"""Landed crawls read page by page, as far as the client that asked for them would have gone.

A crawl is a folder ``crawl=<name>`` with folders ``page=<n>`` of JSON envelopes, one a line. ``PagedCrawls`` is a Spark data
source over such folders: a task takes some crawls, opens their pages in order, and stops where the paging rule says so, so
that later pages are never opened. As a stream its offsets are page numbers: a batch brings the pages that have arrived
since. ``stop_pages`` applies the same rules to envelopes that are already a table.
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# A task takes crawls up to this number or size, one at least, and hands lines on in batches of this size, one line at least.
CRAWLS_A_TASK = 32
TASK_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
RULES = ("empty", "total", "token")
PAGES_DDL = "crawl string, page int, value string"


class _Crawls(InputPartition):
    """Some crawls with their numbered pages, and which pages are wanted: those after ``after`` up to ``until``."""

    def __init__(self, crawls: list[tuple[str, list[tuple[int, list[str]]]]], after: int, until: int) -> None:
        self.crawls, self.after, self.until = crawls, after, until


def _member(envelope: object, path: str) -> object:
    """A value by its dotted path; None where a part of the path is missing."""
    for name in path.split("."):
        envelope = envelope.get(name) if isinstance(envelope, dict) else None
    return envelope


class _Rules:
    """The options of the source: where the crawls lie, and when one ends."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"].rstrip("/")
        self.records = options.get("records", "data")
        self.stop = options.get("stop", "empty")
        if self.stop not in RULES:
            raise ValueError(f"stop must be one of {', '.join(RULES)}, not {self.stop}")
        self.total = options.get("total", "total")
        self.token = options.get("token", "next_page_token")
        self.max_pages = int(options["maxpages"]) if "maxpages" in options else None
        self.sizes: dict[str, int] = {}

    def _where(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if re.match(r"\w+:", self.path) else (fs.LocalFileSystem(), self.path)

    def listed(self) -> list[tuple[str, list[tuple[int, list[str]]]]]:
        """Crawls by name, each with its pages by number and the files of a page by name; ``sizes`` gets the bytes of each
        crawl. Files are not opened."""
        where, root = self._where()
        self.sizes = {}
        found: dict[str, dict[int, list[str]]] = {}
        for entry in where.get_file_info(fs.FileSelector(root, recursive=True)):
            place = re.fullmatch(r"/crawl=([^/]+)/page=(\d+)/[^/._][^/]*", entry.path[len(root) :])
            if place and entry.is_file:
                found.setdefault(place[1], {}).setdefault(int(place[2]), []).append(entry.path)
                self.sizes[place[1]] = self.sizes.get(place[1], 0) + (entry.size or 0)
        return [(crawl, [(page, sorted(files)) for page, files in sorted(pages.items())]) for crawl, pages in sorted(found.items())]

    def _lines(self, files: list[str]) -> Iterator[str]:
        where, _ = self._where()
        for file in files:
            with where.open_input_stream(file) as stream:
                for raw in io.BufferedReader(stream, 1 << 20):
                    yield from filter(str.strip, raw.decode("utf-8", "replace").splitlines())

    def taken(self, pages: list[tuple[int, list[str]]]) -> Iterator[tuple[int, str]]:
        """``(page, line)`` of a crawl up to its end: a missing page, the allowed number of pages, or the rule's stop.

        A line that is no JSON object counts as an envelope without records and is passed on, so that it can be rejected.
        Lines are held back only up to the page's first record.
        """
        fetched = 0
        for place, (page, files) in enumerate(pages):
            if page != pages[0][0] + place or (self.max_pages is not None and place >= self.max_pages):
                return
            sent, total, token = 0, 0, None
            held: list[str] = []
            for line in self._lines(files):
                try:
                    envelope = json.loads(line)
                except ValueError:
                    envelope = None
                records = _member(envelope, self.records)
                sent += len(records) if isinstance(records, list) else 0
                total = max(total, _whole(_member(envelope, self.total)))
                token = _member(envelope, self.token) or token
                del envelope, records
                held.append(line)
                if sent:
                    yield from ((page, line) for line in held)
                    held.clear()
            if not sent:
                return
            fetched += sent
            if (self.stop == "total" and fetched >= total) or (self.stop == "token" and not token):
                return


def _whole(value: object) -> int:
    return int(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else 0


def _dealt(rules: _Rules, after: int, until: int) -> list[_Crawls]:
    parts: list[list] = [[]]
    taken = 0
    for crawl in rules.listed():
        size = rules.sizes[crawl[0]]
        if parts[-1] and (len(parts[-1]) == CRAWLS_A_TASK or taken + size > TASK_BYTES):
            parts.append([])
            taken = 0
        parts[-1].append(crawl)
        taken += size
    # Spark asks for one task at least.
    return [_Crawls(part, after, until) for part in parts]


def _batch(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    crawl, page, value = zip(*rows)
    arrays = [pa.array(crawl, pa.string()), pa.array(page, pa.int32()), pa.array(value, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["crawl", "page", "value"])


def _read(rules: _Rules, part: _Crawls) -> Iterator[pa.RecordBatch]:
    """The rows in batches of bounded size: Spark would gather rows by their number, however long their lines are."""
    rows: list[tuple[str, int, str]] = []
    size = 0
    for crawl, pages in part.crawls:
        for page, line in rules.taken([p for p in pages if p[0] <= part.until]):
            if page > part.after:
                rows.append((crawl, page, line))
                size += len(line)
                if size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
    if rows:
        yield _batch(rows)


LAST_PAGE = (1 << 31) - 1


class _Reader(DataSourceReader):
    def __init__(self, rules: _Rules) -> None:
        self._rules = rules

    def partitions(self) -> list[_Crawls]:
        return _dealt(self._rules, -1, LAST_PAGE)

    def read(self, partition: _Crawls) -> Iterator[pa.RecordBatch]:
        return _read(self._rules, partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, rules: _Rules) -> None:
        self._rules = rules

    def initialOffset(self) -> dict:
        return {"page": -1}

    def latestOffset(self) -> dict:
        return {"page": max((pages[-1][0] for _, pages in self._rules.listed()), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[_Crawls]:
        return _dealt(self._rules, start["page"], end["page"])

    def read(self, partition: _Crawls) -> Iterator[pa.RecordBatch]:
        return _read(self._rules, partition)


class PagedCrawls(DataSource):
    """``spark.read.format("paged_crawls")`` with the options ``path``, ``records`` (the envelope's array), ``stop``,
    ``total`` and ``token`` (dotted paths) and ``maxPages``; rows ``(crawl, page, value)``.

    ``stop`` is ``empty`` (a page without records ends a crawl), ``total`` (so does reaching the total that the page
    states, 0 if it states none) or ``token`` (so does a page without a token for the next one). An empty page ends every
    crawl and gives no rows. Pages are numbered from the crawl's first; a missing number ends it.

    As a stream, pages are taken in the order of their numbers: a page that arrives after a later number was read in
    any crawl is passed over, so the crawls of a stream go on together and a new round of crawls takes a new folder.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_crawls"

    def schema(self) -> str:
        return PAGES_DDL

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(_Rules(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(_Rules(self.options))


def _options(path: str, records: str, stop: str, max_pages: int | None, total: str, token: str) -> dict[str, str]:
    found = {"path": path, "records": records, "stop": stop, "total": total, "token": token}
    return found if max_pages is None else found | {"maxPages": str(max_pages)}


def read_crawls(
    spark: SparkSession, path: str, records: str, stop: str = "empty", max_pages: int | None = None, total: str = "total", token: str = "next_page_token"
) -> DataFrame:
    """``(crawl, page, value)`` of all landed crawls, each up to its end."""
    spark.dataSource.register(PagedCrawls)
    return spark.read.format("paged_crawls").options(**_options(path, records, stop, max_pages, total, token)).load()


def stream_crawls(
    spark: SparkSession, path: str, records: str, stop: str = "empty", max_pages: int | None = None, total: str = "total", token: str = "next_page_token"
) -> DataFrame:
    """The same as a stream over pages as they arrive."""
    spark.dataSource.register(PagedCrawls)
    return spark.readStream.format("paged_crawls").options(**_options(path, records, stop, max_pages, total, token)).load()


def stop_pages(pages: DataFrame, n_records: Column, stop: str = "empty", max_pages: int | None = None, total: Column | None = None, token: Column | None = None) -> DataFrame:
    """The rows of ``pages`` (``crawl``, ``page`` and others, one envelope a page) up to the end of each crawl.

    One window over the pages of a crawl, of which only numbers travel: sizes are added up, and the first page that ends the
    crawl is found.
    """
    if stop not in RULES:
        raise ValueError(f"stop must be one of {', '.join(RULES)}, not {stop}")
    order = Window.partitionBy("crawl").orderBy("page")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sent = F.coalesce(n_records, F.lit(0))
    place = F.col("page") - F.min("page").over(order)
    ends = {
        "empty": F.lit(False),
        "total": F.sum("_sent").over(order) >= F.coalesce(F.lit(0) if total is None else total, F.lit(0)),
        "token": F.lit(True) if token is None else F.coalesce(token == "", F.lit(True)),
    }[stop]
    gone = (F.col("_sent") == 0) | (place != F.row_number().over(order) - 1)
    if max_pages is not None:
        gone = gone | (place >= max_pages)
    marked = pages.withColumn("_sent", sent).withColumns({"_gone": gone, "_ends": ends})
    kept = ~F.coalesce(F.bool_or("_ends").over(before), F.lit(False)) & ~F.bool_or("_gone").over(order)
    return marked.withColumn("_kept", kept).filter("_kept").drop("_sent", "_gone", "_ends", "_kept")
