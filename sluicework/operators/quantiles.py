"""Exact quantiles, box statistics and histograms per group, without bringing a group together in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_STEPS_PER_OCTAVE = 256


def _bucket(value: Column) -> Column:
    """A number that never falls as the value grows: steps of equal ratio, so skewed values spread evenly.

    It is declared non-null, so that joining on it adds no filter to one of the two plans that share the counts.
    """
    size = F.floor(F.log2(F.abs(value) + 1) * _STEPS_PER_OCTAVE)
    return F.coalesce(F.when(value < 0, -size).otherwise(size).cast("bigint"), F.lit(0))


def _numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, ``value``) as double, without nulls and NaN."""
    rows = df.select(*keys, F.col(value).cast("double").alias("value"))
    return rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def count_distinct_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Copies of each value per group, as (keys, ``value``, ``n``); null values and NaN are left out."""
    return _numbers(df, keys, value).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))


def quantiles_of_counts(values: DataFrame, keys: Sequence[str], fractions: dict[str, float]) -> DataFrame:
    """Exact quantiles (linear interpolation) from distinct values and their counts.

    Steps: count rows per (group, bucket); a running total over the buckets (at most a few thousand per group) tells
    which buckets hold the wanted ranks; only their values are ranked, each bucket on its own. So a group of any size is
    spread over tasks by value, and no sketch is needed.
    """
    bucketed = values.withColumn("_b", _bucket(F.col("value")))
    over_buckets = Window.partitionBy(*keys).orderBy("_b")
    whole = Window.partitionBy(*keys)
    totals = (
        bucketed.groupBy(*keys, "_b")
        .agg(F.sum("n").alias("_in"))
        .withColumn("_upto", F.sum("_in").over(over_buckets.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("total", F.sum("_in").over(whole))
    )
    spots = {name: (F.col("total") - 1) * F.lit(float(p)) for name, p in fractions.items()}
    ranks = [rank for spot in spots.values() for rank in (F.floor(spot), F.ceil(spot))]
    before = F.col("_upto") - F.col("_in")
    holds_rank = F.lit(False)
    for rank in ranks:
        holds_rank = holds_rank | ((rank >= before) & (rank < F.col("_upto")))
    wanted = totals.filter(holds_rank).select(*keys, "_b", before.alias("_before"), "total")
    in_bucket = Window.partitionBy(*keys, "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = bucketed.join(wanted, [*keys, "_b"]).withColumn("_rank", F.col("_before") + F.sum("n").over(in_bucket))
    lows = {n: F.min(F.when(F.col("_rank") > F.floor(s), F.col("value"))).alias(f"_lo_{n}") for n, s in spots.items()}
    highs = {n: F.min(F.when(F.col("_rank") > F.ceil(s), F.col("value"))).alias(f"_hi_{n}") for n, s in spots.items()}
    found = ranked.groupBy(*keys, "total").agg(*lows.values(), *highs.values())
    results = [
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * (s - F.floor(s))).alias(n)
        for n, s in spots.items()
    ]
    return found.select(*keys, F.col("total").alias("n_values"), *results)


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, fractions: dict[str, float], approximate: bool = False
) -> DataFrame:
    """Quantiles per group, named as in ``fractions``; groups with a null key and groups without values drop out.

    ``approximate`` uses Spark's mergeable sketch in a single pass instead.
    """
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    if not approximate:
        return quantiles_of_counts(count_distinct_values(df, keys, value), keys, fractions)
    rows = df.filter(F.col(value).isNotNull())
    sketches = [F.percentile_approx(value, float(p), 10_000).cast("double").alias(n) for n, p in fractions.items()]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_values"), *sketches)


def grouped_median(df: DataFrame, key: str, value: str, name: str = "median", approximate: bool = False) -> DataFrame:
    """Median per group."""
    return grouped_quantiles(df, [key], value, {name: 0.5}, approximate).drop("n_values")


def box_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Box-plot numbers per category: quartiles, whiskers (furthest values within 1.5 box lengths) and outlier count."""
    values = count_distinct_values(df.filter(F.col(key).isNotNull()), [key], value)
    quartiles = quantiles_of_counts(values, [key], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    fenced = values.join(quartiles, key)
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return fenced.groupBy(key, "n_values", "q1", "median", "q3").agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
    )


def outliers(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows outside the whiskers of their category."""
    box = box_stats(df, key, value).select(key, "whisker_low", "whisker_high")
    number = F.col(value).cast("double")
    beyond = (number < F.col("whisker_low")) | (number > F.col("whisker_high"))
    return df.join(box, key).filter(beyond).drop("whisker_low", "whisker_high")


def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """``bins`` bins of equal width from the smallest to the largest value, empty ones included; the last is closed."""
    rows = _numbers(df, [], value)
    span = rows.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    place = F.when(hi > lo, F.least(F.width_bucket(F.col("value"), lo, hi, F.lit(bins)), F.lit(bins))).otherwise(1)
    counts = rows.select(place.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return every.join(counts, "bin", "left").select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("bin_start"),
        (lo + F.col("bin") * width).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
    )
