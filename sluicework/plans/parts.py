"""Gold from parts: sums and counts stored once a run and added up, so that a report does not read the postings again.

A run only inserts, so the parts of all runs together are those of the whole table. A part is small (a row for each
province, week or company of a run) and is written in overwrite mode, so that a run that is repeated replaces its own.
Companies are kept by name, one row a run and name: their number is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework import lookups
from sluicework.operators.aggregates import weekly_counts
from sluicework.plans.ingest import Store

PROVINCES_DDL = "province string, n bigint, job_count bigint, pay double, paid bigint, remote bigint, senior bigint"
WEEKS_DDL = "week_start date, job_count bigint, remote_count bigint"
COMPANIES_DDL = "company_name string, jobs bigint, remote bigint, known_remote bigint, salary_jobs bigint"
RUN = "ingest_run string"


def _provinces(postings: DataFrame) -> DataFrame:
    pay = F.when(F.col("salary_min") > 0, F.col("salary_min"))
    return postings.groupBy(F.col("location_state").alias("province")).agg(
        F.count("*").alias("n"),
        F.count("location_state").alias("job_count"),
        F.sum(pay).alias("pay"),
        F.count(pay).alias("paid"),
        F.count_if("is_remote").alias("remote"),
        F.count_if(F.col("seniority").isin(lookups.SENIOR_LABELS)).alias("senior"),
    )


def _companies(postings: DataFrame) -> DataFrame:
    return postings.groupBy("company_name").agg(
        F.count("*").alias("jobs"), F.count_if("is_remote").alias("remote"), F.count("is_remote").alias("known_remote"), F.count("salary_min").alias("salary_jobs")
    )


PARTS = {
    "province_parts": (_provinces, PROVINCES_DDL),
    "week_parts": (lambda rows: weekly_counts(rows, "posted_at", F.col("is_remote")), WEEKS_DDL),
    "company_parts": (_companies, COMPANIES_DDL),
}


def add_run(spark: SparkSession, store: Store, run: str) -> None:
    """Store the parts of a run from the postings that it inserted."""
    own = store.postings(spark).filter(F.col("ingest_run") == run).drop("ingest_run")
    for name, (build, _) in PARTS.items():
        build(own).write.mode("overwrite").parquet(store.path(name, run))


def _read(spark: SparkSession, store: Store, name: str) -> DataFrame:
    return store.read(spark, name, f"{PARTS[name][1]}, {RUN}")


def _rate(part: str) -> Column:
    return F.round(100.0 * F.sum(part) / F.sum("n"), 1)


def province_stats(spark: SparkSession, store: Store) -> DataFrame:
    """``gold.province_stats`` of all stored postings."""
    return (
        _read(spark, store, "province_parts")
        .groupBy("province")
        .agg(
            F.sum("job_count").alias("job_count"),
            F.round(F.try_divide(F.sum("pay"), F.sum("paid")), 0).alias("avg_salary"),
            _rate("remote").alias("remote_rate"),
            _rate("senior").alias("senior_rate"),
        )
        .filter(F.col("job_count") > 0)
    )


def weekly_trends(spark: SparkSession, store: Store) -> DataFrame:
    """``gold.weekly_trends`` of all stored postings."""
    weeks = _read(spark, store, "week_parts").groupBy("week_start")
    return weeks.agg(F.sum("job_count").alias("job_count"), F.sum("remote_count").alias("remote_count")).orderBy("week_start")


def overview_kpis(spark: SparkSession, store: Store) -> DataFrame:
    """``gold.overview_kpis`` of all stored postings."""
    return _read(spark, store, "company_parts").agg(
        F.coalesce(F.sum("jobs"), F.lit(0)).alias("total_jobs"),
        F.coalesce((F.try_divide(F.sum("remote"), F.sum("known_remote")) * 100).cast("int"), F.lit(0)).alias("remote_pct"),
        F.count_distinct("company_name").alias("companies"),
        F.coalesce(F.sum("salary_jobs"), F.lit(0)).alias("salary_jobs"),
    )
