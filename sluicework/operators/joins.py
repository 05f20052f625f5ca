"""Joins. No side is broadcast by hint unless its size is fixed by its construction; otherwise run-time statistics
decide, and hot keys of the probing side are split by adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.functions.text import strip_accents

NULL_SPREAD = 512


def value_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small constant table, built inside the plan."""
    fields = StructType.fromDDL(ddl).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def left_join_spread_nulls(
    left: DataFrame, right: DataFrame, key: str, right_key: str, spread_by: str | None = None
) -> DataFrame:
    """LEFT equi-join whose null-keyed rows are spread over partitions.

    Rows without a key match nothing, yet a plain left join would send all of them to one task. Each gets a stand-in
    key from a hash of ``spread_by`` (by default of the whole row), starting with a NUL character that no real key has.
    """
    spread = [spread_by] if spread_by else left.columns
    bucket = F.pmod(F.xxhash64(*spread), F.lit(NULL_SPREAD)).cast("string")
    probe = F.coalesce(F.col(key), F.concat(F.lit("\0"), bucket))
    joined = left.withColumn("_probe", probe).join(
        right.withColumnRenamed(right_key, "_match"), F.col("_probe") == F.col("_match"), "left"
    )
    return joined.drop("_probe", "_match")


def complete_domain(stats: DataFrame, key: str, domain: Sequence[str]) -> DataFrame:
    """One row per value of the domain, with its statistics or nulls."""
    full = value_table(stats.sparkSession, [(v,) for v in domain], f"{key} string")
    return full.join(stats, key, "left")


def lookup_join(df: DataFrame, table: DataFrame, key: str, default: dict[str, object] | None = None) -> DataFrame:
    """LEFT lookup in a table too large for a literal map; defaults fill its columns where the key is unknown.

    ``table`` has unique keys.
    """
    joined = df.join(table, key, "left")
    for column, value in (default or {}).items():
        joined = joined.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
    return joined


def inner_lookup(df: DataFrame, rows: Sequence[tuple], ddl: str, key: str) -> DataFrame:
    """INNER lookup in a constant table: rows with an unknown key drop out."""
    return df.join(F.broadcast(value_table(df.sparkSession, rows, ddl)), key, "inner")


def join_by_plain_name(features: DataFrame, stats: DataFrame, name: str, key: str) -> DataFrame:
    """LEFT join on names compared without accents; ``name`` becomes the accent-free form."""
    plain = features.withColumn(name, strip_accents(F.col(name)))
    return plain.join(stats.withColumnRenamed(key, name), name, "left")


def keep_top_values(df: DataFrame, column: str, k: int, counts: DataFrame | None = None) -> DataFrame:
    """Rows whose value is among the ``k`` most frequent (ties by value). The broadcast side has ``k`` rows."""
    top = (counts if counts is not None else count_values(df, column)).orderBy(
        F.col("count").desc(), F.col(column).asc()
    )
    return df.join(F.broadcast(top.limit(k).select(column)), column, "left_semi")


def count_values(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, as ``count``."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def fill_from(base: DataFrame, curated: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Null fields of ``base`` take the curated value of the same key; ``filled`` marks the rows that changed.

    Of several curated rows with a key one counts: the last in the order of all its values, nulls first.
    """
    order = F.struct(*(F.col(c) for c in columns))
    single = curated.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(order).alias("_row")).select(key, "_row.*")
    offer = single.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = base.join(offer, key, "left")
    changed = F.lit(False)
    filled: dict[str, Column] = {}
    for c in columns:
        changed = changed | (F.col(c).isNull() & F.col(f"_new_{c}").isNotNull())
        filled[c] = F.coalesce(F.col(c), F.col(f"_new_{c}"))
    return joined.withColumn("filled", changed).withColumns(filled).drop(*[f"_new_{c}" for c in columns])
