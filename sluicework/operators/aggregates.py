"""Counting operators. All are partial aggregates: rows are combined before they are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework import lookups
from sluicework.functions.lookup import lookup, title_case
from sluicework.operators.filters import top_n


def value_counts(df: DataFrame, column: str, keep_null: bool = False, n: int | None = None) -> DataFrame:
    """Rows per value as ``count``, most frequent first, ties by value; optionally nulls too, and only the first ``n``."""
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    return top_n(rows.groupBy(column).agg(F.count(F.lit(1)).alias("count")), "count", n, [column])


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """One row: number of distinct non-null values as ``n_distinct``."""
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(F.col(column))
    return df.agg(count.alias("n_distinct"))


def share_of_total(counts: DataFrame, count: str = "count", decimals: int = 1) -> DataFrame:
    """Counts with each one's share of their sum, in percent, as ``share``.

    The sum is a scalar subquery over the same counts, so large sets of groups are not brought together in one task.
    """
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn("share", F.bround(F.lit(100.0) * F.col(count) / total, decimals))


def percent_of_max(df: DataFrame, column: str, name: str = "width") -> DataFrame:
    """Each value as percent of the largest one."""
    return df.withColumn(name, F.col(column) / df.agg(F.max(column)).scalar() * 100)


def count_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per pair of non-null values as ``count``."""
    rows = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``row`` against the listed values of ``column``, one output column each, zero where there are none.

    The values are given, so no pass is needed to find them.
    """
    listed = df.filter(F.col(row).isNotNull() & F.col(column).isin(list(values)))
    return listed.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def top_values(df: DataFrame, column: str, k: int) -> list[str]:
    """The ``k`` most frequent values, for use as columns of ``crosstab``; only ``k`` rows reach the driver."""
    return [r[0] for r in value_counts(df, column, n=k).collect()]


def tag_frequency(
    df: DataFrame,
    tags: str = "skills_tags",
    categories: dict[str, str] = lookups.TAG_CATEGORY,
    names: dict[str, str] = lookups.TAG_DISPLAY,
    other: str = lookups.TAG_CATEGORY_DEFAULT,
) -> DataFrame:
    """Mentions per tag: ``count``, ``pct`` of all rows (not of mentions), category and written form.

    The number of rows is a scalar subquery that reads no more than the columns the given rows were filtered by.
    """
    counts = (
        df.select(F.explode(tags).alias("skill"))
        .filter(F.col("skill") != "")
        .groupBy("skill")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    tag = F.col("skill")
    return counts.select(
        "skill",
        "count",
        F.bround(F.col("count") / total * 100, 1).alias("pct"),
        lookup(tag, categories, F.lit(other)).alias("category"),
        lookup(tag, names, title_case(tag)).alias("display_name"),
    )


def frequency_tables(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Top values of several columns in one scan, as (field, value, count, place); null counts as a value.

    The number per column says how many values to keep.
    """
    pairs = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = (
        df.select(F.inline(F.array(*pairs))).groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))
    )
    order = Window.partitionBy("field").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    ranked = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max(columns.values()))
    return ranked.filter(F.col("place") <= lookup(F.col("field"), columns))


def weekly_counts(df: DataFrame, time: str, flag: Column) -> DataFrame:
    """Rows and flagged rows per week (Monday start) as ``week_start``, ``job_count``, ``remote_count``."""
    week = F.date_trunc("week", F.col(time)).cast("date")
    return (
        df.filter(F.col(time).isNotNull())
        .groupBy(week.alias("week_start"))
        .agg(F.count(F.lit(1)).alias("job_count"), F.count_if(flag).alias("remote_count"))
    )
