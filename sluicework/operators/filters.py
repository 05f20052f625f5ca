"""Filters, projections, ordering and sampling over record tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.operators.joins import value_table


def known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is null."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def annual_pay(df: DataFrame) -> DataFrame:
    """Rows with a minimum salary that is stated per year."""
    return df.filter(F.col("salary_min").isNotNull() & (F.col("salary_period") == "YEAR"))


def since(
    df: DataFrame, column: str, as_of: Column | None = None, days: int | None = None, start: datetime | None = None
) -> DataFrame:
    """Rows no older than ``days`` before ``as_of`` or than a fixed ``start``; rows without a time drop out.

    The bound is a constant next to a bare column, so it reaches the scan. With neither bound all rows stay.
    """
    if days is not None:
        bound = (F.current_timestamp() if as_of is None else as_of) - F.make_dt_interval(F.lit(days))
        return df.filter(F.col(column) >= bound)
    if start is not None:
        return df.filter(F.col(column) >= F.lit(start))
    return df


def apply_filters(df: DataFrame, choices: Mapping[str, str | None], everything: str | None = None) -> DataFrame:
    """Equality filter per column; a choice of None or of ``everything`` keeps all rows."""
    for column, choice in choices.items():
        if choice is not None and choice != everything:
            df = df.filter(F.col(column) == choice)
    return df


def one_of(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows whose value is in a list."""
    return df.filter(F.col(column).isin(list(values)))


def search(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text holds the regular expression, ignoring case; an empty pattern keeps all rows."""
    return df.filter(F.coalesce(F.col(column).rlike(f"(?iu){pattern}"), F.lit(False))) if pattern else df


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns for output."""
    return df.withColumnsRenamed(dict(names))


def existing_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that the table has, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def top_n(df: DataFrame, by: str, n: int | None, tie: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """First ``n`` rows by a column, ties broken by further columns, so that the cut is the same on every run."""
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    ordered = df.orderBy(first, *[F.col(c).asc_nulls_first() for c in tie])
    return ordered if n is None else ordered.limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (fewer if there are fewer) in pseudo-random order of a hash of the key; repeatable."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}"))), F.col(key)).limit(n)


def raw_against_silver(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Working and raw value side by side, with a flag where they differ (null-safe)."""
    columns = []
    for f in fields:
        raw = F.col(f"{f}_raw")
        columns += [F.col(f), raw, (~F.col(f).eqNullSafe(raw)).alias(f"{f}_changed")]
    return df.select("job_id", *columns)


def in_order(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Only the listed values, with their place as ``ord``, in the listed order."""
    places = value_table(df.sparkSession, [(v, i) for i, v in enumerate(order)], f"{column} string, ord int")
    return df.join(F.broadcast(places), column, "inner").orderBy("ord")


def listed_first(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Listed values first, in the listed order; others after them by value. Adds the place as ``ord``."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))
    known_place = F.when(place > 0, place - 1).otherwise(F.lit(len(order))).cast("int")
    return df.withColumn("ord", known_place).orderBy("ord", column)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)
