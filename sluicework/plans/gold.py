"""Gold tables: what reports read. Every function takes the Silver table (or companies, counts) and returns a table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework import lookups, schemas
from sluicework.functions.lookup import (
    display_count,
    display_money,
    display_percent,
    display_thousands,
    percent,
)
from sluicework.operators import aggregates, filters, joins, quantiles


def _count() -> Column:
    return F.count(F.lit(1))


def _senior() -> Column:
    return F.col("seniority").isin(lookups.SENIOR_LABELS)


COMPANY_COLUMNS = {
    "industry": "industry",
    "employee_count": "employee_count",
    "employee_range": "employee_range",
    "linkedin_url": "company_linkedin_url",
    "website_url": "company_website_url",
    "city": "company_city",
    "country": "company_country",
}


def jobs_enriched(postings: DataFrame, companies: DataFrame) -> DataFrame:
    """Postings with their company's details; postings without a known company keep nulls there."""
    details = companies.select("domain", *[F.col(c).alias(a) for c, a in COMPANY_COLUMNS.items()])
    times = [c for c in ("fetched_at", "created_at", "updated_at") if c in postings.columns]
    working = [*schemas.FIELDS[:-1], *schemas.DERIVED_FIELDS, "posted_at"]
    narrow = postings.select("job_id", *working, *schemas.RAW_FIELDS, *times)
    return joins.left_join_spread_nulls(narrow, details, "company_domain", "domain", "job_id")


def province_stats(postings: DataFrame) -> DataFrame:
    """Per province: postings, mean of the positive minimum salaries, remote and senior rates in percent.

    Rows without a province fall into one group, which is dropped by its zero count. A filter on the province itself
    would be pushed below the projection that computes it and make Spark compute it twice when Silver is not stored.
    """
    pay = F.when(F.col("salary_min") > 0, F.col("salary_min"))
    return (
        postings.groupBy(F.col("location_state").alias("province"))
        .agg(
            F.count("location_state").alias("job_count"),
            F.round(F.avg(pay), 0).alias("avg_salary"),
            F.round(100.0 * F.count_if("is_remote") / _count(), 1).alias("remote_rate"),
            F.round(100.0 * F.count_if(_senior()) / _count(), 1).alias("senior_rate"),
        )
        .filter(F.col("job_count") > 0)
    )


def province_totals(stats: DataFrame) -> DataFrame:
    """One row: postings with a province, provinces with postings."""
    return stats.agg(
        F.coalesce(F.sum("job_count"), F.lit(0)).alias("total_with_province"),
        F.count_if(F.col("job_count") > 0).alias("provinces_active"),
    )


def national_rates(postings: DataFrame) -> DataFrame:
    """One row: remote rate over rows with a known flag, senior rate over rows with a known level; 0.0 when none."""
    return postings.agg(
        percent(F.count_if("is_remote"), F.count("is_remote")).alias("national_remote"),
        percent(F.count_if(_senior()), F.count("seniority")).alias("national_senior"),
    )


def province_map(stats: DataFrame, domain: Sequence[str] = tuple(lookups.PROVINCE_DOMAIN)) -> DataFrame:
    """Statistics for every province of the domain, nulls where there are no postings."""
    return joins.complete_domain(stats, "province", domain)


def province_table(postings: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Display table per province: postings, rates and the median of all minimum salaries."""
    stats = province_stats(postings) if stats is None else stats
    located = filters.known(postings, "location_state", "salary_min")
    medians = quantiles.grouped_median(located, "location_state", "salary_min", "median_salary")
    joined = stats.join(medians.withColumnRenamed("location_state", "province"), "province", "left")
    return joined.select(
        F.col("province").alias("Province"),
        F.col("job_count").alias("Jobs"),
        display_percent(F.col("remote_rate")).alias("Remote"),
        display_percent(F.col("senior_rate")).alias("Senior+"),
        display_thousands(F.col("median_salary")).alias("Median Salary"),
    )


# Metric name -> (column of province_stats, label, display).
METRICS = {
    "Job Volume": ("job_count", "Job Postings", display_count),
    "Remote Rate": ("remote_rate", "Remote Rate", display_percent),
    "Senior+ Rate": ("senior_rate", "Senior / Lead / Director+", display_percent),
    "Avg Salary": ("avg_salary", "Avg Salary (CAD)", display_thousands),
}


def metric_display(stats: DataFrame, metric: str) -> DataFrame:
    """One metric of the registry per province, as number and as text."""
    column, _, display = METRICS[metric]
    return stats.select("province", F.col(column).cast("double").alias("value"), display(F.col(column)).alias("text"))


def metrics_display(stats: DataFrame) -> DataFrame:
    """All metrics of the registry per province, one row each, in one pass over the statistics."""
    shown = F.array(
        *(
            F.struct(F.lit(name).alias("metric"), F.lit(label).alias("label"), F.col(c).cast("double").alias("value"), display(F.col(c)).alias("text"))
            for name, (c, label, display) in METRICS.items()
        )
    )
    return stats.select("province", F.inline(shown))


def map_features(features: DataFrame, stats: DataFrame, name: str = "name") -> DataFrame:
    """Geographic features with display texts of their province, found by accent-free name; '—' where there is none."""
    joined = joins.join_by_plain_name(features, stats, name, "province")
    return joined.select(
        *features.columns,
        display_count(F.col("job_count")).alias("jobs_text"),
        display_percent(F.col("remote_rate")).alias("remote_text"),
        display_percent(F.col("senior_rate")).alias("senior_text"),
        display_thousands(F.col("avg_salary")).alias("salary_text"),
    )


def overview_kpis(postings: DataFrame) -> DataFrame:
    """One row: postings, remote percent cut to a whole number, distinct companies, postings with a salary."""
    share = F.avg(F.col("is_remote").cast("int")) * 100
    return postings.agg(
        _count().alias("total_jobs"),
        F.coalesce(share.cast("int"), F.lit(0)).alias("remote_pct"),
        F.count_distinct("company_name").alias("companies"),
        F.count("salary_min").alias("salary_jobs"),
    )


def salary_coverage(postings: DataFrame) -> DataFrame:
    """One row: postings with yearly pay and their percentage."""
    yearly = F.col("salary_min").isNotNull() & (F.col("salary_period") == "YEAR")
    return postings.agg(
        F.count_if(yearly).alias("salary_jobs"), percent(F.count_if(yearly), _count()).alias("salary_pct")
    )


def ordered_seniority(postings: DataFrame, order: Sequence[str] = tuple(lookups.SENIORITY_ORDER)) -> DataFrame:
    """Postings per seniority level, in level order."""
    return filters.in_order(joins.count_values(postings, "seniority"), "seniority", order)


def top_companies(postings: DataFrame, n: int | None = 20) -> DataFrame:
    """The companies with most postings: remote count, mean minimum salary, remote percent."""
    per_company = (
        filters.known(postings, "company_name")
        .groupBy("company_name")
        .agg(
            F.count("job_id").alias("job_count"),
            F.count_if("is_remote").alias("remote_count"),
            F.avg("salary_min").alias("avg_salary_min"),
        )
        .withColumn("remote_pct", percent(F.col("remote_count"), F.col("job_count")))
    )
    return filters.top_n(per_company, "job_count", n, ["company_name"])


def company_summary(postings: DataFrame, arrival: str = "job_id", search: str = "") -> DataFrame:
    """Browse table per company: first known domain, postings, remote share, mean pay, most common level.

    Rows are first combined per (company, level), then per company, so the common level needs no list of all levels
    and a large company is no hot group. Of equally common levels the lowest in the alphabet is shown.
    """
    first_domain = F.min(
        F.when(F.col("company_domain").isNotNull(), F.struct(F.col(arrival), F.col("company_domain").alias("d")))
    )
    per_level = (
        filters.known(postings, "company_name")
        .groupBy("company_name", "seniority")
        .agg(
            first_domain.alias("first"),
            F.count("job_id").alias("jobs"),
            _count().alias("rows"),
            F.count_if("is_remote").alias("remote"),
            F.count("is_remote").alias("flagged"),
            F.sum("salary_min").alias("pay"),
            F.count("salary_min").alias("paid"),
        )
    )
    rank = F.when(F.col("seniority").isNotNull(), F.struct(-F.col("rows"), F.col("seniority").alias("level")))
    summary = per_level.groupBy("company_name").agg(
        F.min("first")["d"].alias("domain"),
        F.sum("jobs").alias("jobs"),
        display_percent(F.lit(100.0) * F.try_divide(F.sum("remote"), F.sum("flagged"))).alias("remote_pct"),
        display_money(F.try_divide(F.sum("pay"), F.sum("paid"))).alias("avg_salary_min"),
        F.coalesce(F.min(rank)["level"], F.lit("—")).alias("top_seniority"),
    )
    return filters.top_n(filters.search(summary, "company_name", search), "jobs", None, ["company_name"])


BROWSE_NAMES = {
    "company_name": "Company",
    "domain": "Domain",
    "jobs": "Postings",
    "remote_pct": "Remote %",
    "avg_salary_min": "Avg Min Salary",
    "top_seniority": "Most Common Level",
}


def company_table(postings: DataFrame, search: str = "") -> DataFrame:
    """``company_summary`` under its display names."""
    return filters.rename(company_summary(postings, search=search), BROWSE_NAMES)


def top_titles(postings: DataFrame, n: int | None = 10, approximate: bool = False) -> DataFrame:
    """Titles with the highest median yearly minimum salary."""
    medians = quantiles.grouped_median(
        filters.annual_pay(postings), "title", "salary_min", "median_salary", approximate
    )
    return filters.top_n(medians, "median_salary", n, ["title"])


def salary_box(postings: DataFrame, by: str = "employment_type") -> DataFrame:
    """Box-plot numbers of yearly minimum pay per category."""
    return quantiles.box_stats(filters.annual_pay(postings), by, "salary_min")


def salary_histogram(postings: DataFrame, bins: int = 40) -> DataFrame:
    """Histogram of yearly minimum pay."""
    return quantiles.histogram(filters.annual_pay(postings), "salary_min", bins)


def weekly_trends(postings: DataFrame) -> DataFrame:
    """Postings and remote postings per week, oldest first."""
    return aggregates.weekly_counts(postings, "posted_at", F.col("is_remote")).orderBy("week_start")


def skill_selection(
    postings: DataFrame,
    province: str | None = None,
    seniority: str | None = None,
    as_of: Column | None = None,
    days: int | None = None,
    start: datetime | None = None,
) -> DataFrame:
    """Postings chosen by time, province and level; None keeps all."""
    recent = filters.since(postings, "posted_at", as_of, days, start)
    return filters.apply_filters(recent, {"location_state": province, "seniority": seniority})


def skill_frequency(postings: DataFrame, category: str | None = None, n: int | None = None) -> DataFrame:
    """Tags by mentions with their percentage of all postings given; one category or all, top ``n`` or all."""
    tags = filters.apply_filters(aggregates.tag_frequency(postings), {"category": category})
    return filters.top_n(tags, "count", n, ["skill"])


def skill_bars(postings: DataFrame, category: str | None = None, n: int | None = 25) -> DataFrame:
    """``skill_frequency`` with each bar's width in percent of the widest."""
    return aggregates.percent_of_max(skill_frequency(postings, category, n), "pct", "width")


def skill_kpis(postings: DataFrame, category: str | None = None, n: int | None = 25) -> DataFrame:
    """One row: tags tracked, tags found, the most frequent tag and its rate."""
    tracked = len(lookups.TAG_CATEGORIES[category]) if category else len(lookups.TAG_DISPLAY)
    found = skill_frequency(postings, category, n)
    top = F.min(F.struct((-F.col("count")).alias("c"), "skill", "display_name", "pct"))
    return found.agg(
        F.lit(tracked).alias("skills_tracked"),
        _count().alias("skills_found"),
        F.coalesce(top["display_name"], F.lit("—")).alias("top_skill"),
        F.coalesce(F.format_string("%.1f%%", top["pct"]), F.lit("—")).alias("top_pct"),
    )


def skills_by_seniority(
    postings: DataFrame,
    skills: Sequence[str] | None = None,
    k: int = 15,
    order: Sequence[str] = tuple(lookups.SENIORITY_ORDER),
) -> DataFrame:
    """Level × tag counts for the listed tags (by default the ``k`` most frequent), in level order."""
    tags = postings.select("seniority", F.explode("skills_tags").alias("skill"))
    skills = aggregates.top_values(tags, "skill", k) if skills is None else skills
    return filters.in_order(aggregates.crosstab(tags, "seniority", "skill", skills), "seniority", order)


def skills_by_seniority_rows(postings: DataFrame, k: int = 15) -> DataFrame:
    """``skills_by_seniority`` of the ``k`` most frequent tags as rows (level, place of the level, tag, count)."""
    wide = skills_by_seniority(postings, None, k)
    skills = [c for c in wide.columns if c not in ("seniority", "ord")]
    cells = F.array(*(F.struct(F.lit(c).alias("skill"), F.col(f"`{c}`").alias("count")) for c in skills))
    return wide.select("seniority", "ord", F.inline(cells)) if skills else wide.select("seniority", "ord", F.lit("").alias("skill"), F.lit(0).alias("count"))


def city_density(postings: DataFrame) -> DataFrame:
    """Postings per city with known coordinates, and the size of its dot."""
    counts = joins.count_values(postings, "location_city")
    rows = [(city, lat, lon) for city, (lat, lon) in lookups.CITY_COORDINATES.items()]
    placed = joins.inner_lookup(counts, rows, "location_city string, lat double, lon double", "location_city")
    weight = F.lit(4.0) + F.log1p(F.col("count")) * 3.5
    return placed.withColumn("radius", F.greatest(F.lit(4.0), F.least(F.lit(24.0), weight)))


def top_cities_by_seniority(postings: DataFrame, k: int = 10) -> DataFrame:
    """Postings per (city, level) in the ``k`` cities with most postings.

    The cities are ranked by the sums of the pair counts, so the postings are read once.
    """
    pairs = (
        filters.known(postings, "location_city")
        .groupBy("location_city", "seniority")
        .agg(_count().alias("count"))
    )
    cities = pairs.groupBy("location_city").agg(F.sum("count").alias("count"))
    return joins.keep_top_values(pairs.filter(F.col("seniority").isNotNull()), "location_city", k, cities)


def province_share(postings: DataFrame) -> DataFrame:
    """Postings per province with their share."""
    return aggregates.share_of_total(joins.count_values(postings, "location_state"))


def pick_list(postings: DataFrame, column: str) -> DataFrame:
    """Distinct values for a selection box; levels come in level order, others by value."""
    if column == "seniority":
        values = filters.known(postings.select(column), column).distinct()
        return filters.listed_first(values, column, lookups.SENIORITY_ORDER)
    return filters.distinct_sorted(postings, column)
