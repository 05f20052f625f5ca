"""Attribute normalisation as column expressions: places, types, pay, time, domains."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicework import lookups
from sluicework.functions.lookup import blank_to_null, let, lookup
from sluicework.functions.text import strip_accents, strip_space

# --- places ---------------------------------------------------------------------------------------------------------


def normalize_province(state: Column, table: Mapping[str, str] = lookups.PROVINCE_NAMES) -> Column:
    """Canonical province for a name or code; unknown values lose accents and outer space; '' is null."""
    plain = strip_accents(strip_space(blank_to_null(state)))
    return let(plain, lambda p: lookup(F.lower(p), table, p))


def normalize_city(city: Column, aliases: Mapping[str, str | None] = lookups.CITY_ALIASES) -> Column:
    """City without accents, alias resolved (an alias may mean "no city"), trailing "region" removed; '' is null."""
    known = {k: v for k, v in aliases.items() if v is not None}

    def resolve(plain: Column) -> Column:
        shortened = let(strip_space(F.regexp_replace(plain, r"(?iU)\s+region\s*$", "")), blank_to_null)
        is_alias = F.lower(plain).isin(list(aliases))
        return F.when(is_alias, lookup(F.lower(plain), known)).otherwise(shortened)

    return let(strip_accents(strip_space(blank_to_null(city))), resolve)


def normalize_country(
    country: Column, table: Mapping[str, str] = lookups.COUNTRY_NAMES, default: str = lookups.COUNTRY_DEFAULT
) -> Column:
    """Canonical country; the default when missing or blank."""
    found = let(strip_space(country), lambda p: lookup(F.lower(p), table, blank_to_null(p)))
    return F.coalesce(found, F.lit(default))


def normalize_employment_type(kind: Column, table: Mapping[str, str] = lookups.EMPLOYMENT_TYPES) -> Column:
    """Canonical employment type; unknown values are only stripped; '' is null."""
    return let(strip_space(blank_to_null(kind)), lambda p: lookup(F.lower(p), table, p))


def province_of_city(city: Column, table: Mapping[str, str] = lookups.CITY_PROVINCES) -> Column:
    """Province of a known city, ignoring case and accents; null for others."""
    return lookup(F.lower(strip_accents(city)), table)


def split_location(text: Column) -> Column:
    """Struct (city, province, country) of "City, Province, Country"; two parts lack the city, one is a country."""


    def assign(parts: Column) -> Column:
        n = F.size(parts)
        city = F.when(n >= 3, F.try_element_at(parts, F.lit(1)))
        province = F.when(n >= 2, F.try_element_at(parts, n - 1))
        country = F.when(n >= 1, F.try_element_at(parts, n))
        return F.struct(city.alias("city"), province.alias("province"), country.alias("country"))

    return let(F.transform(F.split(blank_to_null(text), ","), strip_space), assign)


def split_area(area: Column, default_country: str = "Canada") -> Column:
    """Struct (city, province, country) of an array that runs from the country down to the place."""
    n = F.coalesce(F.size(area), F.lit(0))
    country = F.when(n >= 1, F.try_element_at(area, F.lit(1))).otherwise(F.lit(default_country))
    province = F.when(n >= 2, F.try_element_at(area, F.lit(2)))
    city = F.when(n >= 3, F.try_element_at(area, F.lit(-1)))
    return F.struct(city.alias("city"), province.alias("province"), country.alias("country"))


# --- pay ------------------------------------------------------------------------------------------------------------


def parse_amount(text: Column) -> Column:
    """First amount of money in a text: 'CA$80K' -> 80000.0; null when there is none."""
    pattern = lookups.AMOUNT_PATTERN
    value = F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit("")).try_cast("double")
    return F.when(F.regexp_extract(text, pattern, 2) != "", value * 1000).otherwise(value)


def parse_salary_range(text: Column) -> Column:
    """Struct (low, high) of "low – high"; one amount gives only ``low``."""
    amounts = F.transform(F.split(blank_to_null(text), lookups.RANGE_PATTERN, 2), parse_amount)
    return let(amounts, lambda a: F.struct(F.get(a, F.lit(0)).alias("low"), F.get(a, F.lit(1)).alias("high")))


def parse_salary_period(text: Column) -> Column:
    """Pay period named in a text: HOUR, MONTH or YEAR; null when none is named."""
    low = F.lower(text)
    return (
        F.when(low.contains("hour"), F.lit("HOUR"))
        .when(low.contains("month"), F.lit("MONTH"))
        .when(low.contains("year"), F.lit("YEAR"))
    )


def annualize(
    amount: Column, period: Column, hours: int = lookups.HOURS_PER_YEAR, cap: float = lookups.ANNUAL_CAP
) -> Column:
    """Hourly pay as a year's pay, null above the cap; pay of any other period is unchanged."""
    yearly = F.bround(amount * F.lit(hours), 2)
    hourly = F.coalesce(period == "HOUR", F.lit(False))
    return F.when(hourly, F.when(yearly <= cap, yearly)).otherwise(amount)


def annual_period(period: Column) -> Column:
    """Period after ``annualize``: hourly becomes YEAR, missing becomes YEAR, others stay."""
    return F.when(period == "HOUR", F.lit("YEAR")).otherwise(F.coalesce(blank_to_null(period), F.lit("YEAR")))


# --- time -----------------------------------------------------------------------------------------------------------

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def relative_to_timestamp(text: Column, as_of: Column, tz: str = "America/Toronto") -> Column:
    """'3 days ago' -> the instant that reads three days earlier on the wall clock of ``tz``; null if not of that form.

    The shift is done on microseconds, so it does not depend on the session's time zone.
    """
    pattern = r"(?U)\A(\d+)\s+(second|minute|hour|day|week)s?\s+ago"
    first = -62_135_596_800_000_000  # 0001-01-01, the earliest instant a timestamp is meant to hold
    local = F.unix_micros(F.from_utc_timestamp(as_of, tz))

    def shift(clean: Column) -> Column:
        amount = F.regexp_extract(clean, pattern, 1).try_cast("bigint")
        unit = lookup(F.regexp_extract(clean, pattern, 2), _UNIT_SECONDS).cast("bigint")
        return F.try_multiply(F.try_multiply(amount, unit), F.lit(1_000_000))

    def instant(past: Column) -> Column:
        return F.when(past >= F.lit(first), F.to_utc_timestamp(F.timestamp_micros(past), tz))

    return let(F.try_subtract(local, let(F.lower(strip_space(text)), shift)), instant)


def parse_posted_at(text: Column, as_of: Column, tz: str = "America/Toronto") -> Column:
    """Timestamp of a relative ("… ago") or an ISO text; null for anything else."""
    relative = F.lower(text).contains("ago")
    return F.when(relative, relative_to_timestamp(text, as_of, tz)).otherwise(coerce_timestamp(text))


def coerce_timestamp(text: Column) -> Column:
    """Timestamp of an ISO text; null for anything else."""
    return F.try_to_timestamp(blank_to_null(strip_space(text)))


def coerce_number(value: Column) -> Column:
    """Number of a text; null for anything else."""
    return value.try_cast("double")


# --- domains --------------------------------------------------------------------------------------------------------


def normalize_domain(url: Column) -> Column:
    """Host (with port) of a URL: scheme optional, 'www.' removed, lower case, no outer '/'; null when there is none."""
    scheme = r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"

    def place(full: Column) -> Column:
        host = F.regexp_extract(full, rf"{scheme}//([^/?#]*)", 1)
        path = F.regexp_extract(full, rf"{scheme}(?://)?([^?#;]*)", 1)
        return let(host, lambda h: F.when(h.contains("[") == h.contains("]"), F.when(h != "", h).otherwise(path)))

    given = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("https://"), url))
    found = let(F.regexp_replace(given, r"[\t\r\n]", ""), place)
    bare = F.lower(F.replace(found, F.lit("www."), F.lit("")))
    return F.when(url != "", let(F.regexp_replace(bare, r"\A/+|/+\z", ""), blank_to_null))
