"""Postings derived from the test tables.

The tables hold no postings, so one posting is derived from each order (with its customer and nation): every raw field
is built from the order's columns, with nulls, blanks, accents, markup and odd values mixed in. ``FEED`` is portable SQL
that Spark and DuckDB both run; it also states what the payload texts mean (``pay_low``, ``place_city`` …), so that the
parsers can be checked against values that no parser made.
"""

from __future__ import annotations

from sluicework import lookups

AS_OF = "2024-03-12 15:00:00"  # two days after a change to summer time


def _pick(expr: str, values: list[str]) -> str:
    """CASE over the remainder of a key; the values are SQL expressions."""
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"(CASE ({expr}) % {len(values)} {arms} END)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_N = "CAST(k % 12 AS STRING)"
_N3 = "CAST(k % 12 + 3 AS STRING)"
_A = "CAST(40 + k % 80 AS STRING)"
_B = "CAST(70 + k % 80 AS STRING)"
_H = "CAST(20 + k % 40 AS STRING)"
_H2 = "CAST(25 + k % 40 AS STRING)"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"

TITLE = (
    "CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN '' ELSE "
    + _pick(
        "k",
        ["'Senior '", "'Junior '", "'Lead '", "'Director of '", "'Intern, '", "'Associate '", "'Staff '", "'Sr. '",
         "'Vice  President '", "'Entry-Level '", "'Données – '", "''", "'Data '"],
    )
    + " || c_mktsegment || "
    + _pick("k", ["' Analyst'", "' Scientist'", "' Engineer'"])
    + " END"
)
CITY = _pick(
    "k",
    ["'Toronto'", "'Montréal'", "'  Vancouver '", "'Greater Vancouver'", "'Waterloo Region'", "'Downtown'",
     "'Québec City'", "'St. John''s'", "'Halifax Regional Municipality'", "'Fort McMurray Region'", "'Springfield'",
     "''", "NULL", "'Calgary'", "'TORONTO'", "'Thunder Bay region '", "n_name"],
)
STATE = _pick(
    "k",
    ["'ON'", "'Ontario'", "'B.C.'", "'Québec'", "'qc'", "n_name", "''", "NULL", "' ab '", "NULL", "'Newfoundland'"],
)
COUNTRY = _pick("k", ["'CA'", "'Canada'", "' canada '", "''", "NULL", "'US'", "'anywhere'"])
KIND = _pick(
    "k + 5",
    ["'FULL_TIME'", "'Full-time'", "'Full Time'", "'contract'", "'CONTRACTOR'", "'part_time'", "'Intern'",
     "'permanent'", "' Casual '", "''", "NULL", "'temp'", "'pt'"],
)
PERIOD = _pick("k + o_custkey", ["'YEAR'", "'YEAR'", "'HOUR'", "'MONTH'", "NULL", "''", "'YEAR'"])
CURRENCY = _pick("k", ["'CAD'", "'USD'", "''", "NULL", "'CAD'"])
SITE = _pick(
    "k",
    ["NULL", "''", "lower(c_mktsegment) || n_nationkey || '.example.com/'"]
    + ["'https://www.' || lower(c_mktsegment) || n_nationkey || '.example.com/jobs?x=1'"] * 6,
)


def _tag(expr: str) -> str:
    n = len(lookups.TAXONOMY)
    return f"split_part({_text('|'.join(lookups.TAXONOMY))}, '|', CAST(({expr}) % {n} AS INT) + 1)"


_DESCRIPTION = (
    "CASE WHEN k % 41 = 0 THEN '' WHEN k % 43 = 0 THEN NULL ELSE '<div title=\"a>b\"><p>Join our <b>' || c_mktsegment "
    "|| '</b> team &amp; partners.</p>\n<ul><li>' || "
    + _tag("k")
    + " || '</li><li>' || upper("
    + _tag("k + o_custkey")
    + ") || '</li></ul> ' || "
    + _pick("k", ["'R&amp;D'", "'JavaScript and NoSQL'", "'SQL/Python, <i>Power BI</i>'", "''", "'1 &lt; 2 &copy;'"])
    + " || ' ' || "
    + _pick(
        "k",
        [f"'Requires ' || {_N} || '+ years of experience.'", f"{_N} || '-' || {_N3} || ' years of relevant experience'",
         f"'Minimum of ' || {_N} || ' years.'", f"'At least ' || {_N} || ' years.'",
         f"{_N} || ' to ' || {_N3} || ' years experience'", "'15 years in business'", "''", "''", "''"],
    )
    + " || "
    + _pick(
        "k",
        ["' Office in Toronto, ON.'", "' Based in Montreal Quebec today.'", "' London on the river.'",
         "' Richmond Hill, Ontario.'", "' Move to Halifax, BC soon.'", "' Serving all , AB and more'",
         "' Montreal, Quebec City, QC'", "' St. John''s NL'", "''", "''"],
    )
    + " || "
    + _pick("k", ["' Remote friendly'", "' You may Work From Home'"] + ["''"] * 9)
    + " || '<script>if (a < b) { go(\"</p>\"); }</script><!-- ref <b>' || k || '</b> --></div>' END"
)
_ISO = _pick("k", ["NULL", "'not a date'", _DAY, f"{_DAY} || 'T10:30:00Z'", _DAY, f"{_DAY} || 'T23:59:59Z'", _DAY])
_AGO = _pick(
    "k",
    ["CAST(k % 50 AS STRING) || ' days ago'", "'1 day ago'", "CAST(k % 30 AS STRING) || ' hours ago'",
     "CAST(k % 9 AS STRING) || ' weeks ago'", "'Just posted'", "'30+ days ago'", "'1 month ago'", "NULL",
     "CAST(k % 59 AS STRING) || ' Minutes ago'"],
)
_PAY_TEXT = _pick(
    "o_custkey",
    [f"'CA$' || {_A} || ',000–$' || {_B} || ',000 a year'", f"'$' || {_H} || ' – $' || {_H2} || ' an hour'",
     f"'CA$' || {_A} || 'K a year'", f"'$' || {_H} || ',000 a month'", f"{_A} || '-' || {_B} || 'k'",
     f"{_H} || ' to ' || {_H2} || ' an hour'", "'Competitive'", "NULL", "''"],
)
_PAY_LOW = _pick(
    "o_custkey",
    ["(40 + k % 80) * 1000", "20 + k % 40", "(40 + k % 80) * 1000", "(20 + k % 40) * 1000", "40 + k % 80",
     "20 + k % 40", "NULL", "NULL", "NULL"],
)
_PAY_HIGH = _pick(
    "o_custkey",
    ["(70 + k % 80) * 1000", "25 + k % 40", "NULL", "NULL", "(70 + k % 80) * 1000", "25 + k % 40", "NULL", "NULL",
     "NULL"],
)
_PAY_PERIOD = _pick(
    "o_custkey", ["'YEAR'", "'HOUR'", "'YEAR'", "'MONTH'", "NULL", "'HOUR'", "NULL", "NULL", "NULL"]
)

_ORDERS = """
  SELECT o_orderkey AS k, o_custkey, o_totalprice, o_orderdate, c_mktsegment, n_name,
         CAST(n_nationkey AS STRING) AS n_nationkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

FEED = f"""
SELECT p.*,
  (CASE k % 3 WHEN 0 THEN city || ', ' || state || ', ' || country WHEN 1 THEN state || ', ' || country
              ELSE country END) AS place,
  (CASE WHEN k % 3 = 0 AND state || country IS NOT NULL THEN trim(city) END) AS place_city,
  (CASE WHEN k % 3 = 2 OR (k % 3 = 0 AND city IS NULL) THEN NULL WHEN country IS NULL THEN NULL
        ELSE trim(state) END) AS place_state,
  (CASE WHEN k % 3 = 2 THEN nullif(trim(country), '') WHEN k % 3 = 1 AND state IS NULL THEN NULL
        WHEN k % 3 = 0 AND city || state IS NULL THEN NULL ELSE trim(country) END) AS place_country,
  CAST(CASE WHEN k % 5 = 0 THEN NULL WHEN period = 'HOUR' THEN 15 + k % 300 ELSE o_totalprice END AS DOUBLE) AS low,
  CAST(CASE WHEN k % 7 = 0 THEN NULL WHEN period = 'HOUR' THEN 25 + k % 300
            WHEN k % 19 = 0 THEN o_totalprice - 1 ELSE o_totalprice + 10000 END AS DOUBLE) AS high
FROM (
  SELECT k, o_orderdate, o_totalprice, k % 5 AS depth,
    (CASE k % 4 WHEN 0 THEN 'adzuna' WHEN 1 THEN 'theirstack' WHEN 2 THEN 'serpapi' ELSE 'jsearch' END) AS feed,
    (CASE WHEN k % 23 = 0 THEN NULL ELSE c_mktsegment || ' ' || n_name END) AS company,
    {TITLE} AS title, {SITE} AS site, {CITY} AS city, {STATE} AS state, {COUNTRY} AS country, {KIND} AS kind,
    {PERIOD} AS period, {CURRENCY} AS currency, {_DESCRIPTION} AS description, {_ISO} AS iso, {_AGO} AS ago,
    (CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END) AS remote,
    (CASE WHEN k % 47 = 0 THEN NULL
          ELSE 'https://jobs.' || lower(c_mktsegment) || '.example.org/apply/' || k END) AS link,
    'https://logo.example.com/' || n_nationkey || '.png' AS logo,
    {_PAY_TEXT} AS pay_text, CAST({_PAY_LOW} AS DOUBLE) AS pay_low, CAST({_PAY_HIGH} AS DOUBLE) AS pay_high,
    {_PAY_PERIOD} AS pay_period
  FROM ({_ORDERS}) t
) p
"""

BRONZE = f"""
SELECT (CASE feed WHEN 'jsearch' THEN '' ELSE feed || '_' END) || k AS job_id,
  title AS title_raw, company AS company_name_raw,
  (CASE feed WHEN 'jsearch' THEN coalesce(nullif(site, ''), link) WHEN 'theirstack' THEN site END)
    AS company_domain_raw,
  (CASE feed WHEN 'serpapi' THEN place_city WHEN 'adzuna' THEN CASE WHEN depth > 2 THEN city END ELSE city END)
    AS location_city_raw,
  (CASE feed WHEN 'serpapi' THEN place_state WHEN 'adzuna' THEN CASE WHEN depth > 1 THEN state END ELSE state END)
    AS location_state_raw,
  (CASE feed WHEN 'serpapi' THEN place_country WHEN 'adzuna' THEN CASE WHEN depth > 0 THEN country ELSE 'Canada' END
             ELSE country END) AS location_country_raw,
  (CASE feed WHEN 'adzuna' THEN NULL ELSE remote END) AS is_remote_raw,
  kind AS employment_type_raw,
  (CASE feed WHEN 'serpapi' THEN pay_low ELSE low END) AS salary_min_raw,
  (CASE feed WHEN 'serpapi' THEN pay_high ELSE high END) AS salary_max_raw,
  (CASE WHEN feed IN ('adzuna', 'serpapi') THEN 'CAD' ELSE currency END) AS salary_currency_raw,
  (CASE feed WHEN 'adzuna' THEN 'YEAR' WHEN 'serpapi' THEN pay_period ELSE period END) AS salary_period_raw,
  description AS job_description_raw, link AS job_apply_link_raw,
  (CASE feed WHEN 'adzuna' THEN NULL ELSE logo END) AS employer_logo_raw,
  (CASE feed WHEN 'serpapi' THEN ago ELSE iso END) AS posted_at_raw,
  k, feed, o_orderdate
FROM ({FEED}) f
"""

# Companies already on file: those of all regions but one.
COMPANIES = """
SELECT DISTINCT lower(c_mktsegment) || n_nationkey || '.example.com' AS domain, c_mktsegment || ' ' || n_name AS name,
  c_mktsegment AS industry, 10 * n_nationkey + 5 AS employee_count,
  (CASE WHEN n_nationkey < 10 THEN '1-100' ELSE '101-500' END) AS employee_range,
  'https://in.example.com/' || n_nationkey AS linkedin_url, 'https://www.example.com/' || n_nationkey AS website_url,
  n_name AS city, CAST(NULL AS STRING) AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2
"""
