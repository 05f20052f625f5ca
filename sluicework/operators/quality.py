"""Data-quality profiling and constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.functions.lookup import percent
from sluicework.functions.text import has_odd_characters
from sluicework.operators import aggregates
from sluicework.operators.filters import top_n
from sluicework.operators.joins import left_join_spread_nulls
from sluicework.sources.readers import source_of

FREQUENCY_FIELDS = {
    "location_state": 50,
    "location_city": 40,
    "location_country": 20,
    "seniority": 20,
    "salary_currency": 20,
    "source": 10,
    "years_experience_min": 20,
}


def _missing(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def _low_pay(limit: float) -> Column:
    return (F.col("salary_min") != 0) & (F.col("salary_min") < limit)


def profile_summary(df: DataFrame, low_limit: float = 200) -> DataFrame:
    """One row of counts and percentages; a single aggregate over a single scan."""
    n = F.count(F.lit(1))
    no_state, no_city = F.count_if(_missing("location_state")), F.count_if(_missing("location_city"))
    no_years = F.count_if(F.col("years_experience_min").isNull())
    no_tags = F.count_if(F.coalesce(F.size("skills_tags"), F.lit(0)) <= 0)
    flipped = (F.col("salary_min") != 0) & (F.col("salary_max") != 0) & (F.col("salary_min") > F.col("salary_max"))
    return df.agg(
        n.alias("total_rows"),
        no_state.alias("null_state"),
        percent(no_state, n).alias("null_state_pct"),
        no_city.alias("null_city"),
        percent(no_city, n).alias("null_city_pct"),
        F.count("salary_min").alias("has_min"),
        percent(F.count("salary_min"), n).alias("has_min_pct"),
        F.count("salary_max").alias("has_max"),
        percent(F.count("salary_max"), n).alias("has_max_pct"),
        F.count_if(flipped).alias("flipped_pay"),
        F.count_if(_low_pay(low_limit)).alias("low_pay"),
        F.count_if(has_odd_characters(F.col("title"))).alias("odd_titles"),
        no_years.alias("null_years"),
        percent(no_years, n).alias("null_years_pct"),
        no_tags.alias("no_tags"),
        percent(no_tags, n).alias("no_tags_pct"),
    )


def profile_frequencies(df: DataFrame, fields: dict[str, int] = FREQUENCY_FIELDS) -> DataFrame:
    """Most frequent values of all profiled fields, in one scan; ``source`` is read off the id."""
    return aggregates.frequency_tables(df.withColumn("source", source_of(F.col("job_id"))), fields)


def source_distribution(df: DataFrame, n: int | None = 10) -> DataFrame:
    """Rows per source."""
    return aggregates.value_counts(df.select(source_of(F.col("job_id")).alias("source")), "source", n=n)


def low_pay_rows(df: DataFrame, n: int | None = 10, limit: float = 200) -> DataFrame:
    """First rows whose pay looks hourly."""
    rows = df.filter(_low_pay(limit)).select("job_id", "salary_min", "salary_max", "salary_currency")
    return top_n(rows, "job_id", n, descending=False)


def odd_titles(df: DataFrame, n: int | None = 20) -> DataFrame:
    """First titles with symbols or characters outside ASCII."""
    return top_n(df.filter(has_odd_characters(F.col("title"))).select("job_id", "title"), "job_id", n, descending=False)


def top_tags(df: DataFrame, tags: str = "skills_tags", n: int | None = 30) -> DataFrame:
    """Most frequent single tags."""
    return aggregates.value_counts(df.select(F.explode(tags).alias("skill")), "skill", n=n)


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that are null or occur more than once, with their number of rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return counts.filter((F.col("count") > 1) | F.col(key).isNull())


def _lacking(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Distinct keys without a parent."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return keys.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def orphans(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose non-null key has no parent.

    Distinct keys are checked first; rows are then matched against the few that fail.
    """
    return df.join(_lacking(df, parent, key, parent_key), key, "left_semi")


def clear_orphans(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """The rows with keys that have no parent set to null (what deleting a parent does)."""
    lacking = _lacking(df, parent, key, parent_key).withColumn("_orphan", F.lit(True))
    marked = left_join_spread_nulls(df, lacking, key, key)
    return marked.withColumn(key, F.when(F.col("_orphan").isNull(), F.col(key))).drop("_orphan").select(df.columns)


