"""Bronze to Silver: one declarative plan over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework import lookups, schemas
from sluicework.functions.lookup import blank_to_null
from sluicework.functions.normalize import (
    annual_period,
    annualize,
    normalize_city,
    normalize_country,
    normalize_domain,
    normalize_employment_type,
    normalize_province,
    parse_posted_at,
    province_of_city,
)
from sluicework.functions.text import (
    classify_by_rules,
    clean_html,
    extract_tags,
    extract_years,
    infer_flag_from_text,
    infer_location_from_text,
)

DEFAULT_CURRENCY = "CAD"


def copy_to_silver(bronze: DataFrame, default_currency: str = DEFAULT_CURRENCY) -> DataFrame:
    """Copy the raw columns to their working names, with defaults for the remote flag and the currency."""
    defaults = {
        "is_remote": F.coalesce(F.col("is_remote_raw"), F.lit(False)),
        "salary_currency": F.coalesce(blank_to_null(F.col("salary_currency_raw")), F.lit(default_currency)),
    }
    copied = {f: defaults.get(f, F.col(f"{f}_raw")) for f in schemas.FIELDS}
    return bronze.withColumns(copied)


def bronze_fallback(rows: DataFrame) -> DataFrame:
    """Null raw columns take the working column's value, so that stored rows can be transformed again."""
    filled = {
        f"{f}_raw": F.coalesce(
            F.col(f"{f}_raw"), F.col(f).cast(schemas.RAW_TYPES.get(f"{f}_raw", "string"))
        )
        for f in schemas.FIELDS
    }
    return rows.withColumns(filled)


def resolve_location(rows: DataFrame, text: str = "job_description") -> DataFrame:
    """City and province: normalised, then the city's province, then what the text says; '' counts as missing.

    The text is scanned only for rows that still lack one of the two.
    """
    known = rows.withColumns(
        {"_city": normalize_city(F.col("location_city")), "_state": normalize_province(F.col("location_state"))}
    ).withColumn("_state", F.coalesce(blank_to_null(F.col("_state")), province_of_city(F.col("_city"))))
    lacking = F.col("_city").isNull() | F.col("_state").isNull()
    scanned = known.withColumn("_found", F.when(lacking, infer_location_from_text(F.col(text))))
    return scanned.withColumns(
        {
            "location_city": F.coalesce(F.col("_city"), F.col("_found.city")),
            "location_state": F.coalesce(F.col("_state"), F.col("_found.province")),
        }
    ).drop("_city", "_state", "_found")


def to_silver(
    bronze: DataFrame,
    as_of: Column | None = None,
    tz: str = "America/Toronto",
    taxonomy: Sequence[str] = tuple(lookups.TAXONOMY),
) -> DataFrame:
    """Bronze rows with all Silver columns added.

    ``as_of`` is the instant that relative dates refer to; it defaults to the row's ``fetched_at``, so a second run over
    the same Bronze gives the same Silver. Raw columns and any others stay as they are.
    """
    as_of = F.col("fetched_at") if as_of is None else as_of
    hourly = F.col("salary_period_raw")
    return (
        copy_to_silver(bronze)
        .withColumn("job_description", clean_html(F.col("job_description_raw")))
        .transform(resolve_location)
        .withColumns(
            {
                "company_domain": normalize_domain(F.col("company_domain_raw")),
                "location_country": normalize_country(F.col("location_country_raw")),
                "employment_type": normalize_employment_type(F.col("employment_type_raw")),
                "salary_min": annualize(F.col("salary_min_raw"), hourly),
                "salary_max": annualize(F.col("salary_max_raw"), hourly),
                "salary_period": annual_period(hourly),
                "posted_at": parse_posted_at(F.col("posted_at_raw"), as_of, tz),
                "is_remote": infer_flag_from_text(F.col("is_remote_raw"), F.col("job_description")),
                "skills_tags": extract_tags(F.col("job_description"), taxonomy),
                "years_experience_min": extract_years(F.col("job_description")),
            }
        )
        .withColumn("seniority", classify_by_rules(F.col("title"), F.col("years_experience_min")))
    )
