"""Payload to Bronze mappings: one projection per source over exploded pages.

A mapping takes a DataFrame of page envelopes and returns ``job_id``, the 16 raw columns and ``pos``, the place of the
record in its page. Columns of the input other than the envelope's array (a page number, say) are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework import schemas
from sluicework.functions.lookup import blank_to_null
from sluicework.functions.normalize import parse_salary_period, parse_salary_range, split_area, split_location

def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _records(pages: DataFrame, array: str) -> DataFrame:
    """One row per record, as struct ``r`` with its place ``pos``; empty pages vanish."""
    envelope = {array, "total", "serpapi_pagination"}
    kept = [c for c in pages.columns if c not in envelope]
    return pages.select(*kept, F.posexplode(array).alias("pos", "r"))


def _bronze(records: DataFrame, job_id: Column, raw: dict[str, Column]) -> DataFrame:
    """Project the mapped columns; a record without an id cannot be keyed and is left out."""
    kept = [c for c in records.columns if c != "r"]
    columns = [raw[f].cast(schemas.RAW_TYPES.get(f"{f}_raw", "string")).alias(f"{f}_raw") for f in schemas.FIELDS]
    return records.select(job_id.alias("job_id"), *columns, *kept).filter(F.col("job_id").isNotNull())


def map_jsearch(pages: DataFrame) -> DataFrame:
    """Flat rename; the domain comes from the employer's site, else from the apply link."""
    r = F.col("r")
    raw = {
        "title": r["job_title"],
        "company_name": r["employer_name"],
        "company_domain": F.coalesce(blank_to_null(r["employer_website"]), r["job_apply_link"]),
        "location_city": r["job_city"],
        "location_state": r["job_state"],
        "location_country": r["job_country"],
        "is_remote": r["job_is_remote"],
        "employment_type": r["job_employment_type"],
        "salary_min": r["job_min_salary"],
        "salary_max": r["job_max_salary"],
        "salary_currency": r["job_salary_currency"],
        "salary_period": r["job_salary_period"],
        "job_description": r["job_description"],
        "job_apply_link": r["job_apply_link"],
        "employer_logo": r["employer_logo"],
        "posted_at": r["job_posted_at_datetime_utc"],
    }
    return _bronze(_records(pages, "data"), r["job_id"], raw)


def map_adzuna(pages: DataFrame) -> DataFrame:
    """Nested company and area; pay is always yearly in CAD; no domain, logo or remote flag."""
    r = F.col("r")
    place = split_area(r["location"]["area"])
    raw = {
        "title": r["title"],
        "company_name": r["company"]["display_name"],
        "company_domain": _null(),
        "location_city": place["city"],
        "location_state": place["province"],
        "location_country": place["country"],
        "is_remote": _null("boolean"),
        "employment_type": r["contract_time"],
        "salary_min": r["salary_min"],
        "salary_max": r["salary_max"],
        "salary_currency": F.lit("CAD"),
        "salary_period": F.lit("YEAR"),
        "job_description": r["description"],
        "job_apply_link": r["redirect_url"],
        "employer_logo": _null(),
        "posted_at": r["created"],
    }
    return _bronze(_records(pages, "results"), F.concat(F.lit("adzuna_"), r["id"]), raw)


def map_theirstack(pages: DataFrame) -> DataFrame:
    """Flat rename with an id prefix."""
    r = F.col("r")
    raw = {
        "title": r["job_title"],
        "company_name": r["company_name"],
        "company_domain": r["company_url"],
        "location_city": r["city"],
        "location_state": r["state"],
        "location_country": r["country"],
        "is_remote": r["remote"],
        "employment_type": r["employment_type"],
        "salary_min": r["salary_min"],
        "salary_max": r["salary_max"],
        "salary_currency": r["salary_currency"],
        "salary_period": r["salary_period"],
        "job_description": r["description"],
        "job_apply_link": r["url"],
        "employer_logo": r["company_logo"],
        "posted_at": r["date_posted"],
    }
    return _bronze(_records(pages, "data"), F.concat(F.lit("theirstack_"), r["id"]), raw)


def map_serpapi(pages: DataFrame, period_from_text: bool = True) -> DataFrame:
    """Location and pay are texts; the first apply option gives the link.

    ``period_from_text`` reads the pay period from the salary text, so that "an hour" is not taken for a year's pay.
    """
    r = F.col("r")
    found = r["detected_extensions"]
    place = split_location(r["location"])
    pay = parse_salary_range(found["salary"])
    raw = {
        "title": r["title"],
        "company_name": r["company_name"],
        "company_domain": _null(),
        "location_city": place["city"],
        "location_state": place["province"],
        "location_country": place["country"],
        "is_remote": found["work_from_home"],
        "employment_type": found["schedule_type"],
        "salary_min": pay["low"],
        "salary_max": pay["high"],
        "salary_currency": F.lit("CAD"),
        "salary_period": parse_salary_period(found["salary"]) if period_from_text else _null(),
        "job_description": r["description"],
        "job_apply_link": F.try_element_at(r["apply_options"], F.lit(1))["link"],
        "employer_logo": r["thumbnail"],
        "posted_at": found["posted_at"],
    }
    return _bronze(_records(pages, "jobs_results"), F.concat(F.lit("serpapi_"), r["job_id"]), raw)


@dataclass(frozen=True)
class Source:
    """A registered source: page schema and mapping. ``rank`` orders the sources in a combined feed."""

    name: str
    page_ddl: str
    mapping: Callable[[DataFrame], DataFrame]
    rank: int


_REGISTRY: dict[str, Source] = {}


def register_source(name: str, page_ddl: str, mapping: Callable[[DataFrame], DataFrame]) -> Source:
    """Add a source, or replace the one of that name in its place."""
    rank = _REGISTRY[name].rank if name in _REGISTRY else len(_REGISTRY)
    _REGISTRY[name] = Source(name, page_ddl, mapping, rank)
    return _REGISTRY[name]


def sources() -> dict[str, Source]:
    """All registered sources, in order."""
    return dict(_REGISTRY)


register_source("jsearch", schemas.JSEARCH_PAGE_DDL, map_jsearch)
register_source("adzuna", schemas.ADZUNA_PAGE_DDL, map_adzuna)
register_source("theirstack", schemas.THEIRSTACK_PAGE_DDL, map_theirstack)
register_source("serpapi", schemas.SERPAPI_PAGE_DDL, map_serpapi)
