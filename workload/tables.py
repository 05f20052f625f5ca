"""The test tables and the tables derived from them, for the registered queries."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.plans.silver import to_silver
from sluicework.session import prepare, working_folder
from sluicework.sources import readers
from workload import derive

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Pages of landed texts are some dozens of folders. A sort by folder would take a task's whole share of the text into memory.
OPEN_TEXTS = 256
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

# Stored Silver per (application, input folder): Gold reads a table, as it would in production.
_STORED: dict[tuple[str, str, str], str] = {}


class Tables:
    """Lazy access to the tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run portable SQL over the tables it names."""
        for name in NAMES:
            if f" {name}" in text:
                table = getattr(self, name)
                # Postings are derived from orders, and what is done with a posting is costly.
                (readers.spread(table) if name == "orders" else table).createOrReplaceTempView(name)
        return self.spark.sql(text)

    @property
    def as_of(self):
        return F.lit(derive.AS_OF).cast("timestamp")

    @cached_property
    def feed(self) -> DataFrame:
        return self.sql(derive.FEED)

    @cached_property
    def bronze(self) -> DataFrame:
        return self.sql(derive.BRONZE)

    @cached_property
    def companies(self) -> DataFrame:
        return self.sql(derive.COMPANIES)

    @contextmanager
    def _open_files(self, most: int):
        """Tasks write up to so many files side by side; beyond that, or with 0, each first sorts its rows by their folder."""
        before = self.spark.conf.get(_WRITERS)
        self.spark.conf.set(_WRITERS, most)
        try:
            yield
        finally:
            self.spark.conf.set(_WRITERS, before)

    def stored(self, name: str, build, form: str = "parquet", *partitions: str) -> str:
        """Path of an intermediate table, written once per application to the shared working folder."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STORED:
            folder = working_folder(self.spark)
            unique = f"{name[:60]}-{uuid.uuid4().hex}"
            path = f"{folder}/{key[0]}/{unique}"
            with self._open_files(OPEN_TEXTS if form == "text" else 0):
                build().write.partitionBy(*partitions).format(form).save(path)
            _STORED[key] = path
        return _STORED[key]

    def silver_of(self, *columns: str) -> DataFrame:
        """Silver with these columns only, stored once; what makes the others is not computed. A stored table that has them
        is read."""
        wanted = sorted(set(columns))
        for (application, folder, name), path in _STORED.items():
            if (application, folder) == (self.spark.sparkContext.applicationId, self.folder):
                if name == "silver" or (name.startswith("silver.") and set(wanted) <= set(name.split(".")[1:])):
                    return self.spark.read.parquet(path).select(*wanted)
        path = self.stored(".".join(["silver", *wanted]), lambda: to_silver(self.bronze, self.as_of).select(*wanted))
        return self.spark.read.parquet(path)

    @property
    def silver_once(self) -> DataFrame:
        """Silver for a query that reads all of it once: what is stored already, else made while it is read."""
        if (self.spark.sparkContext.applicationId, self.folder, "silver") in _STORED:
            return self.silver
        return to_silver(self.bronze, self.as_of)

    @cached_property
    def companies_on_file(self) -> DataFrame:
        """Companies as a stored table, whose size Spark knows when it plans a join."""
        return self.spark.read.parquet(self.stored("companies", lambda: self.companies))

    @cached_property
    def silver(self) -> DataFrame:
        path = self.stored("silver", lambda: to_silver(self.bronze, self.as_of))
        return self.spark.read.parquet(path)
