"""DuckDB twins of the derived tables and of the Silver transform, written independently of the Spark operators."""

from __future__ import annotations

from html.entities import name2codepoint

from sluicework import lookups
from workload import derive


def quote(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def case_map(key: str, table: dict, default: str) -> str:
    """CASE expression for a literal lookup."""
    arms = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in table.items())
    return f"(CASE {key} {arms} ELSE {default} END)"


_RE_SPACE = r"[\s\x{a0}\x{85}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_RE_SPACE}+|{_RE_SPACE}+$', '', 'g')"


def clean_html(x: str) -> str:
    """Markup to spaces (keeping script and style bodies), entities decoded, whitespace collapsed."""
    markup = (
        r"(?is)<!--.*?-->|<script\b[^>]*>(.*?)</script\s*>|<style\b[^>]*>(.*?)</style\s*>|<[!?][^>]*>"
        r"""|</?[a-z](?:[^>=]+|=\s*"[^"]*"|=\s*'[^']*'|=)*>"""
    )
    text = f"regexp_replace({x}, {quote(markup)}, ' \\1\\2 ', 'g')"
    text = f"regexp_replace({text}, '&amp([^a-zA-Z0-9;]|$)', '&amp;\\1', 'g')"
    names = ["lt", "gt", "quot", "nbsp", "copy", "middot", "eacute", "rarr", "mdash", "ndash", "hellip", "reg", "euro"]
    for name in names:
        text = f"replace({text}, '&{name};', chr({name2codepoint[name]}))"
    text = f"replace(replace({text}, '&#39;', ''''), '&amp;', '&')"
    return f"nullif(trim(regexp_replace({text}, '{_RE_SPACE}+', ' ', 'g')), '')"


def province(x: str) -> str:
    plain = f"strip_accents({strip(f'nullif({x}, {EMPTY})')})"
    return case_map(f"lower({plain})", lookups.PROVINCE_NAMES, plain)


def city(x: str) -> str:
    plain = f"strip_accents({strip(f'nullif({x}, {EMPTY})')})"
    shortened = f"nullif({strip(f'regexp_replace({plain}, {quote(REGION)}, {EMPTY})')}, '')"
    return case_map(f"lower({plain})", lookups.CITY_ALIASES, shortened)


EMPTY = "''"
REGION = r"(?i)\s+region\s*$"


def country(x: str) -> str:
    plain = f"nullif({strip(x)}, '')"
    return f"coalesce({case_map(f'lower({plain})', lookups.COUNTRY_NAMES, plain)}, 'Anywhere')"


def employment(x: str) -> str:
    plain = strip(f"nullif({x}, '')")
    return case_map(f"lower({plain})", lookups.EMPLOYMENT_TYPES, plain)


def city_province(x: str) -> str:
    return case_map(f"lower(strip_accents({x}))", lookups.CITY_PROVINCES, "NULL")


def text_city(x: str) -> str:
    """Key of the city found in a text: the longest name first, then table order."""
    codes = "|".join(lookups.PROVINCE_CODES)
    arms = []
    for key in sorted(lookups.CITY_PROVINCES, key=len, reverse=True):
        name = key.replace(".", r"\.").replace("-", r"\-")
        pattern = rf"(?i){name},?\s*(?:{lookups.CITY_PROVINCES[key]}|{codes})\b"
        arms.append(f"WHEN regexp_matches({x}, {quote(pattern)}) THEN {quote(key)}")
    return f"(CASE {' '.join(arms)} END)"


def text_code(x: str) -> str:
    pattern = r"(?:,\s*|\s)(" + "|".join(lookups.PROVINCE_CODES) + r")(?:\s|,|$|\b)"
    return case_map(f"regexp_extract({x}, {quote(pattern)}, 1)", lookups.PROVINCE_CODES, "NULL")


def years(x: str) -> str:
    hits = [f"TRY_CAST(nullif(regexp_extract({x}, {quote('(?i)' + p)}, 1), '') AS INTEGER)" for p in lookups.YEARS_PATTERNS]
    return f"coalesce({', '.join(hits)})"


def seniority(title: str, years_column: str) -> str:
    arms = [
        f"WHEN regexp_matches({title}, {quote('(?i)' + '|'.join(patterns))}) THEN {quote(label)}"
        for label, patterns in lookups.TITLE_RULES
    ]
    arms += [f"WHEN {years_column} <= {limit} THEN {quote(label)}" for limit, label in lookups.YEARS_BRACKETS]
    return f"(CASE {' '.join(arms)} ELSE 'Mid' END)"


def tags(x: str, taxonomy: list[str] = lookups.TAXONOMY) -> str:
    terms = "|".join(t.replace("/", r"/").replace("-", r"\-") for t in taxonomy)
    found = f"regexp_extract_all({x}, {quote(rf'(?i)\b({terms})\b')}, 1)"
    return f"coalesce(list_sort(list_distinct(list_transform({found}, lambda m: lower(m)))), [])"


def domain(x: str) -> str:
    full = f"(CASE WHEN starts_with({x}, 'http') THEN {x} ELSE 'https://' || {x} END)"
    host = rf"regexp_extract({full}, '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)', 1)"
    return f"nullif(trim(lower(replace({host}, 'www.', '')), '/'), '')"


def relative(x: str, as_of: str, tz: str = "America/Toronto") -> str:
    """Wall-clock shift in the zone, back to UTC."""
    pattern = quote(r"(?i)^(\d+)\s+(second|minute|hour|day|week)s?\s+ago")
    n = f"TRY_CAST(nullif(regexp_extract({x}, {pattern}, 1), '') AS BIGINT)"
    unit = f"lower(regexp_extract({x}, {pattern}, 2))"
    seconds = f"(CASE {unit} WHEN 'second' THEN 1 WHEN 'minute' THEN 60 WHEN 'hour' THEN 3600 WHEN 'day' THEN 86400 WHEN 'week' THEN 604800 END)"
    local = f"((TIMESTAMP '{as_of}' AT TIME ZONE 'UTC') AT TIME ZONE '{tz}')"
    return f"((({local}) - to_seconds({n} * {seconds})) AT TIME ZONE '{tz}') AT TIME ZONE 'UTC'"


def posted_at(x: str, as_of: str = derive.AS_OF) -> str:
    iso = f"TRY_CAST(replace({x}, 'Z', '') AS TIMESTAMP)"
    return f"(CASE WHEN contains(lower({x}), 'ago') THEN {relative(x, as_of)} ELSE {iso} END)"


def annual(x: str, period: str = "salary_period_raw") -> str:
    return (
        f"(CASE WHEN {period} = 'HOUR' THEN CASE WHEN round_even({x} * 2080, 2) <= 500000 "
        f"THEN CAST(round_even({x} * 2080, 2) AS DOUBLE) END ELSE {x} END)"
    )


FEED = f"feed AS ({derive.FEED})"
BRONZE = f"bronze AS MATERIALIZED ({derive.BRONZE})"

_CITIES = {k: lookups.city_display(k) for k in lookups.CITY_PROVINCES}

SILVER = f"""
{BRONZE},
cleaned AS MATERIALIZED (
  SELECT *, {clean_html('job_description_raw')} AS job_description,
    {city('location_city_raw')} AS city0, nullif({province('location_state_raw')}, '') AS state0
  FROM bronze),
placed AS (SELECT *, coalesce(state0, {city_province('city0')}) AS state1 FROM cleaned),
scanned AS MATERIALIZED (
  SELECT *, (CASE WHEN city0 IS NULL OR state1 IS NULL THEN {text_city('job_description')} END) AS found,
    (CASE WHEN city0 IS NULL OR state1 IS NULL THEN {text_code('job_description')} END) AS found_code,
    {years('job_description')} AS years_experience_min
  FROM placed),
silver AS MATERIALIZED (
  SELECT job_id, k, o_orderdate, title_raw AS title, company_name_raw AS company_name,
    {domain("nullif(company_domain_raw, '')")} AS company_domain,
    coalesce(city0, {case_map('found', _CITIES, 'NULL')}) AS location_city,
    coalesce(state1, {case_map('found', lookups.CITY_PROVINCES, 'NULL')}, CASE WHEN found IS NULL THEN found_code END)
      AS location_state,
    {country('location_country_raw')} AS location_country,
    (coalesce(is_remote_raw, false) OR coalesce(contains(lower(job_description), 'remote')
       OR contains(lower(job_description), 'work from home'), false)) AS is_remote,
    {employment('employment_type_raw')} AS employment_type,
    {annual('salary_min_raw')} AS salary_min, {annual('salary_max_raw')} AS salary_max,
    coalesce(nullif(salary_currency_raw, ''), 'CAD') AS salary_currency,
    (CASE WHEN salary_period_raw = 'HOUR' THEN 'YEAR' ELSE coalesce(nullif(salary_period_raw, ''), 'YEAR') END)
      AS salary_period,
    job_description, job_apply_link_raw AS job_apply_link, employer_logo_raw AS employer_logo,
    {posted_at('posted_at_raw')} AS posted_at,
    {tags('job_description')} AS skills_tags, years_experience_min,
    {seniority('title_raw', 'years_experience_min')} AS seniority,
    * LIKE '%_raw'
  FROM scanned)
"""
