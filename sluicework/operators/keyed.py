"""A stored table with one row a key that batches are merged into.

Rows lie in folders by a hash of their key. A batch touches the folders of its keys; only these are read, merged and
written again, the others stay as they are. The number of folders is fixed when the table is made, and part of the name of
the column that they are named by, so that a wrong number finds nothing instead of putting rows in wrong places.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.operators.merge import merge_upsert


@dataclass(frozen=True)
class KeyedTable:
    """``path`` of the table, its columns as DDL, its key, and the number of folders: some 500 MB should lie in one."""

    path: str
    ddl: str
    key: str
    parts: int = 64

    @property
    def _column(self) -> str:
        return f"part_of_{self.parts}"

    def part(self, key: Column) -> Column:
        """Folder of a key; null is a key of its own."""
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def _stored(self, spark: SparkSession) -> DataFrame:
        ddl = f"{self.ddl}, {self._column} int"
        try:
            return spark.read.schema(ddl).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], ddl)

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows; empty before the first batch."""
        return self._stored(spark).drop(self._column)

    def get(self, spark: SparkSession, keys: Sequence) -> DataFrame:
        """The rows of some keys: their folders are read and no others, and within these the key is pushed to the scan."""
        kind = spark.createDataFrame([], self.ddl).schema[self.key].dataType
        literals = [F.lit(k).cast(kind) for k in keys]
        parts = sorted({r[0] for r in spark.range(1).select(F.explode(F.array(*map(self.part, literals)))).collect()}) if keys else []
        return self._stored(spark).filter(F.col(self._column).isin(parts) & F.col(self.key).isin(*literals)).drop(self._column)

    def merge(self, incoming: DataFrame, arrival: str | None = "arrival", preserve: Sequence[str] = ("created_at", "fetched_at"), now: Column | None = None) -> list[int]:
        """Insert the rows of a batch, or put them in place of the row of the same key, as ``merge_upsert`` does; returns the
        touched folders.

        ``incoming`` should be a stored batch: it is read to find the folders, and again to be merged. The new folders
        are written beside the old ones and take their places when all are there. A merge that failed on the way may be
        repeated: merging a batch again changes nothing but ``updated_at``, except that rows without a key, which are
        like no other, are inserted again. One merge of a table runs at a time.
        """
        spark = incoming.sparkSession
        touched = sorted(r[0] for r in incoming.select(self.part(F.col(self.key)).alias("part")).distinct().collect())
        if not touched:
            return []
        target = self._stored(spark).filter(F.col(self._column).isin(touched)).drop(self._column)
        merged = merge_upsert(target, incoming, self.key, arrival, preserve, now)
        placed = merged.withColumn(self._column, self.part(F.col(self.key))).repartition(len(touched), self._column)
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self._column)
        writer.parquet(self.path)
        return touched
