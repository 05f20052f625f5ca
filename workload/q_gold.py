"""Gold tables, aggregates and the quality profile."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework import lookups, schemas
from sluicework.operators import aggregates, joins, quality, quantiles
from sluicework.plans import gold
from workload import derive, oracle
from workload.oracle import quote
from workload.registry import query
from workload.tables import Tables

S = f"WITH {oracle.SILVER}"
# What province statistics and company summaries read of Silver.
_STATS_OF = ("location_state", "salary_min", "is_remote", "seniority")
_COMPANY_OF = ("company_name", "company_domain", "job_id", "seniority", "is_remote", "salary_min")
_SENIOR = "seniority IN ('Senior', 'Lead', 'Director+')"


def _pct(num: str, den: str) -> str:
    return f"CAST(coalesce(round_even(100.0::DOUBLE * ({num}) / nullif({den}, 0), 1), 0) AS DOUBLE)"


_STATS = f"""stats AS (
  SELECT location_state AS province, count(*) AS job_count,
    CAST(round(avg(salary_min) FILTER (WHERE salary_min > 0), 0) AS DOUBLE) AS avg_salary,
    CAST(round(100.0::DOUBLE * count(*) FILTER (WHERE is_remote) / count(*), 1) AS DOUBLE) AS remote_rate,
    CAST(round(100.0::DOUBLE * count(*) FILTER (WHERE {_SENIOR}) / count(*), 1) AS DOUBLE) AS senior_rate
  FROM silver WHERE location_state IS NOT NULL GROUP BY 1)"""

# --- joins ----------------------------------------------------------------------------------------------------------

_JOB_COLUMNS = ["job_id", *schemas.FIELDS[:-1], "years_experience_min", "seniority", *schemas.RAW_FIELDS]


@query(
    f"{S}, companies AS ({derive.COMPANIES}) SELECT {', '.join('s.' + c for c in _JOB_COLUMNS)}, "
    "strftime(s.posted_at, '%Y-%m-%d %H:%M:%S') AS posted_at, array_to_string(s.skills_tags, '|') AS skills_tags, "
    "c.industry, c.employee_count, c.employee_range, "
    "c.linkedin_url AS company_linkedin_url, c.website_url AS company_website_url, c.city AS company_city, "
    "c.country AS company_country FROM silver s LEFT JOIN companies c ON s.company_domain = c.domain"
)
def jobs_enriched(t: Tables) -> DataFrame:
    """The whole wide view: working, derived and raw columns, and the company's."""
    rows = gold.jobs_enriched(t.silver_once, t.companies_on_file)
    tags, posted = F.array_join("skills_tags", "|"), F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss")
    return rows.withColumns({"skills_tags": tags, "posted_at": posted})


_DOMAIN = ", ".join(f"({quote(p)})" for p in lookups.PROVINCE_DOMAIN)


@query(
    f"{S}, {_STATS} SELECT d.province, job_count, avg_salary, remote_rate, senior_rate FROM (VALUES {_DOMAIN}) "
    "d(province) LEFT JOIN stats ON d.province = stats.province"
)
def complete_domain(t: Tables) -> DataFrame:
    return gold.province_map(gold.province_stats(t.silver_of(*_STATS_OF)))


_FEATURES = """
SELECT n_nationkey AS feature, (CASE n_nationkey WHEN 0 THEN 'Québec' WHEN 1 THEN 'Ontario' WHEN 2 THEN 'Alberta'
  WHEN 3 THEN 'Yukon' ELSE n_name END) AS name FROM nation
"""


def _whole(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS BIGINT)"


@query(
    f"{S}, {_STATS} SELECT feature, strip_accents(name) AS name, coalesce(format('{{:,}}', job_count), '—') AS "
    f"jobs_text, coalesce({_whole('remote_rate')} || '%', '—') AS remote_text, coalesce({_whole('senior_rate')} || "
    f"'%', '—') AS senior_text, coalesce('$' || {_whole('avg_salary / 1000')} || 'k', '—') AS salary_text "
    f"FROM ({_FEATURES}) f LEFT JOIN stats ON strip_accents(f.name) = province"
)
def map_features(t: Tables) -> DataFrame:
    """Display texts joined to named features, accents ignored."""
    return gold.map_features(t.sql(_FEATURES), gold.province_stats(t.silver_of(*_STATS_OF)))


@query(
    "SELECT o_orderkey, o_custkey, coalesce(c_mktsegment, 'Other') AS c_mktsegment FROM orders LEFT JOIN "
    "(SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey"
)
def lookup_join(t: Tables) -> DataFrame:
    """Lookup with a default in a table that is too large for a literal."""
    table = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = t.orders.select("o_orderkey", "o_custkey")
    return joins.lookup_join(rows, table, "o_custkey", {"c_mktsegment": "Other"})


_COORDS = ", ".join(f"({quote(c)}, {lat}, {lon})" for c, (lat, lon) in lookups.CITY_COORDINATES.items())


@query(
    f"{S} SELECT location_city, count, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, "
    "round(greatest(4.0, least(24.0, 4.0 + ln(1 + count) * 3.5)), 6) AS radius FROM (SELECT location_city, count(*) AS "
    f"count FROM silver GROUP BY 1) JOIN (VALUES {_COORDS}) c(city, lat, lon) ON location_city = city"
)
def city_density(t: Tables) -> DataFrame:
    return gold.city_density(t.silver_of("location_city")).withColumn("radius", F.round("radius", 6))


_TOP_CITIES = (
    "top AS (SELECT location_city FROM silver WHERE location_city IS NOT NULL GROUP BY 1 "
    "ORDER BY count(*) DESC, location_city LIMIT 10)"
)


@query(
    f"{S}, {_TOP_CITIES} SELECT location_city, seniority, count(*) AS count FROM silver WHERE location_city IN (SELECT * "
    "FROM top) AND seniority IS NOT NULL GROUP BY 1, 2"
)
def top_cities_by_seniority(t: Tables) -> DataFrame:
    return gold.top_cities_by_seniority(t.silver_of("location_city", "seniority"))


@query(f"{S}, {_TOP_CITIES} SELECT job_id, location_city FROM silver WHERE location_city IN (SELECT * FROM top)")
def keep_top_values(t: Tables) -> DataFrame:
    return joins.keep_top_values(t.silver_of("job_id", "location_city").select("job_id", "location_city"), "location_city", 10)


# --- aggregates -----------------------------------------------------------------------------------------------------


@query(f"{S}, {_STATS} SELECT * FROM stats")
def province_stats(t: Tables) -> DataFrame:
    return gold.province_stats(t.silver_of(*_STATS_OF))


@query(f"{S}, {_STATS} SELECT * FROM stats")
def province_stats_from_bronze(t: Tables) -> DataFrame:
    """Orders to province statistics in one plan, nothing stored between."""
    from sluicework.plans.silver import to_silver

    return gold.province_stats(to_silver(t.bronze, t.as_of))


@query(
    f"{S}, {_STATS} SELECT CAST(sum(job_count) AS BIGINT) AS total_with_province, count(*) FILTER (WHERE job_count > 0) "
    "AS provinces_active FROM stats"
)
def province_totals(t: Tables) -> DataFrame:
    return gold.province_totals(gold.province_stats(t.silver_of(*_STATS_OF)))


@query(
    f"{S} SELECT {_pct('count(*) FILTER (WHERE is_remote)', 'count(is_remote)')} AS national_remote, "
    f"{_pct(f'count(*) FILTER (WHERE {_SENIOR})', 'count(seniority)')} AS national_senior FROM silver"
)
def national_rates(t: Tables) -> DataFrame:
    return gold.national_rates(t.silver_of("is_remote", "seniority"))


_METRICS = {
    "Job Volume": ("Job Postings", "job_count", "format('{:,}', job_count)"),
    "Remote Rate": ("Remote Rate", "remote_rate", f"{_whole('remote_rate')} || '%'"),
    "Senior+ Rate": ("Senior / Lead / Director+", "senior_rate", f"{_whole('senior_rate')} || '%'"),
    "Avg Salary": ("Avg Salary (CAD)", "avg_salary", f"'$' || {_whole('avg_salary / 1000')} || 'k'"),
}


@query(
    f"{S}, {_STATS} "
    + " UNION ALL ".join(
        f"SELECT province, {quote(m)} AS metric, {quote(label)} AS label, {c}::DOUBLE AS value, coalesce({text}, '—') AS text FROM stats"
        for m, (label, c, text) in _METRICS.items()
    )
)
def metric_display(t: Tables) -> DataFrame:
    """All metrics of the map, as numbers and as texts."""
    return gold.metrics_display(gold.province_stats(t.silver_of(*_STATS_OF)))


_MEDIANS = (
    "medians AS (SELECT location_state, median(salary_min) AS m FROM silver WHERE salary_min IS NOT NULL AND "
    "location_state IS NOT NULL GROUP BY 1)"
)


@query(
    f"{S}, {_STATS}, {_MEDIANS} SELECT province AS \"Province\", job_count AS \"Jobs\", {_whole('remote_rate')} || '%' AS "
    f"\"Remote\", {_whole('senior_rate')} || '%' AS \"Senior+\", coalesce('$' || {_whole('m / 1000')} || 'k', '—') AS "
    "\"Median Salary\" FROM stats LEFT JOIN medians ON province = location_state"
)
def province_table(t: Tables) -> DataFrame:
    return gold.province_table(t.silver_of(*_STATS_OF))


@query(
    f"{S} SELECT count(*) AS total_jobs, CAST(trunc(avg(is_remote::INT) * 100) AS INTEGER) AS remote_pct, "
    "count(DISTINCT company_name) AS companies, count(salary_min) AS salary_jobs FROM silver"
)
def overview_kpis(t: Tables) -> DataFrame:
    return gold.overview_kpis(t.silver_of("is_remote", "company_name", "salary_min"))


@query(
    f"{S} SELECT count(*) FILTER (WHERE salary_min IS NOT NULL AND salary_period = 'YEAR') AS salary_jobs, "
    f"{_pct(chr(32).join(['count(*) FILTER (WHERE salary_min IS NOT NULL AND', 'salary_period =', quote('YEAR'), ')']), 'count(*)')}"
    " AS salary_pct FROM silver"
)
def salary_coverage(t: Tables) -> DataFrame:
    return gold.salary_coverage(t.silver_of("salary_min", "salary_period"))


_ORDER = " ".join(f"WHEN {quote(s)} THEN {i}" for i, s in enumerate(lookups.SENIORITY_ORDER))


@query(
    f"{S} SELECT seniority, count(*) AS count, CAST(CASE seniority {_ORDER} END AS INTEGER) AS ord FROM silver "
    "WHERE seniority IS NOT NULL GROUP BY 1"
)
def ordered_seniority(t: Tables) -> DataFrame:
    return gold.ordered_seniority(t.silver_of("seniority"))


_PER_COMPANY = (
    "SELECT company_name, count(*) AS job_count, count(*) FILTER (WHERE is_remote) AS remote_count, "
    f"round(avg(salary_min), 4) AS avg_salary_min, {_pct('count(*) FILTER (WHERE is_remote)', 'count(*)')} AS remote_pct "
    "FROM silver WHERE company_name IS NOT NULL GROUP BY 1"
)


@query(f"{S} {_PER_COMPANY} ORDER BY job_count DESC, company_name LIMIT 20")
def top_companies(t: Tables) -> DataFrame:
    return gold.top_companies(t.silver_of("job_id", "company_name", "is_remote", "salary_min")).withColumn("avg_salary_min", F.round("avg_salary_min", 4))


_SUMMARY = f"""levels AS (
  SELECT company_name, seniority, row_number() OVER (PARTITION BY company_name ORDER BY count(*) DESC, seniority) AS r
  FROM silver WHERE company_name IS NOT NULL AND seniority IS NOT NULL GROUP BY 1, 2),
summary AS (
  SELECT company_name, arg_min(company_domain, job_id) FILTER (WHERE company_domain IS NOT NULL) AS domain,
    count(*) AS jobs, {_whole('100.0::DOUBLE * count(*) FILTER (WHERE is_remote) / count(*)')} || '%' AS remote_pct,
    coalesce('$' || format('{{:,}}', {_whole('avg(salary_min)')}), '—') AS avg_salary_min,
    coalesce((SELECT l.seniority FROM levels l WHERE l.company_name = s.company_name AND r = 1), '—') AS top_seniority
  FROM silver s WHERE company_name IS NOT NULL GROUP BY 1)"""


@query(f"{S}, {_SUMMARY} SELECT * FROM summary")
def company_summary(t: Tables) -> DataFrame:
    return gold.company_summary(t.silver_of(*_COMPANY_OF))


@query(
    f"{S}, {_SUMMARY} SELECT company_name AS \"Company\", domain AS \"Domain\", jobs AS \"Postings\", remote_pct AS "
    "\"Remote %\", avg_salary_min AS \"Avg Min Salary\", top_seniority AS \"Most Common Level\" FROM summary "
    "WHERE regexp_matches(company_name, '(?i)machin')"
)
def company_table(t: Tables) -> DataFrame:
    return gold.company_table(t.silver_of(*_COMPANY_OF), "machin")


_YEARLY = "FROM silver WHERE salary_min IS NOT NULL AND salary_period = 'YEAR'"


@query(
    f"{S} SELECT title, round(median(salary_min), 4) AS median_salary {_YEARLY} AND title IS NOT NULL GROUP BY 1 "
    "ORDER BY median(salary_min) DESC, title LIMIT 10"
)
def top_titles(t: Tables) -> DataFrame:
    return gold.top_titles(t.silver_of("title", "salary_min", "salary_period")).withColumn("median_salary", F.round("median_salary", 4))


@query(
    f"{S} SELECT title, round(median(salary_min), 4) AS median {_YEARLY} AND title IS NOT NULL GROUP BY 1"
)
def grouped_median(t: Tables) -> DataFrame:
    yearly = t.silver_of("title", "salary_min", "salary_period").filter("salary_period = 'YEAR'")
    return quantiles.grouped_median(yearly, "title", "salary_min").withColumn("median", F.round("median", 4))


@query(
    "SELECT l_returnflag, count(*) AS n_values, round(quantile_cont(l_extendedprice, 0.1), 4) AS p10, "
    "round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99 "
    "FROM lineitem GROUP BY 1"
)
def grouped_quantiles(t: Tables) -> DataFrame:
    """Exact quantiles of three large groups, each spread over tasks by value."""
    fractions = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    rows = quantiles.grouped_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", fractions)
    return rows.withColumns({p: F.round(p, 4) for p in fractions})


def _box(source: str, key: str, value: str) -> str:
    return f"""quartiles AS (
  SELECT {key} AS g, count(*) AS n, quantile_cont({value}, 0.25) AS q1, median({value}) AS q2,
    quantile_cont({value}, 0.75) AS q3, min({value}) AS lo, max({value}) AS hi
  {source} AND {key} IS NOT NULL GROUP BY 1),
box AS (
  SELECT g AS {key}, n AS n_values, round(q1, 4) AS q1, round(q2, 4) AS median, round(q3, 4) AS q3,
    lo AS min_value, hi AS max_value,
    min({value}) FILTER (WHERE {value} >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
    max({value}) FILTER (WHERE {value} <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
    count(*) FILTER (WHERE {value} < q1 - 1.5 * (q3 - q1) OR {value} > q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM (SELECT {key}, {value} {source}) JOIN quartiles ON {key} = g GROUP BY ALL)"""


def _rounded(box: DataFrame) -> DataFrame:
    return box.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query(f"{S}, {_box(_YEARLY, 'employment_type', 'salary_min')} SELECT * FROM box")
def salary_box(t: Tables) -> DataFrame:
    return _rounded(gold.salary_box(t.silver_of("employment_type", "salary_min", "salary_period")))


@query(f"WITH {_box('FROM orders WHERE o_totalprice IS NOT NULL', 'o_orderpriority', 'o_totalprice')} SELECT * FROM box")
def box_stats(t: Tables) -> DataFrame:
    return _rounded(quantiles.box_stats(t.orders, "o_orderpriority", "o_totalprice"))


@query(
    "WITH b AS (SELECT event_type AS g, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events "
    "GROUP BY 1) SELECT event_id, event_type, value FROM events JOIN b ON event_type = g "
    "WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)"
)
def outliers(t: Tables) -> DataFrame:
    return quantiles.outliers(t.events.select("event_id", "event_type", "value"), "event_type", "value")


def _histogram(source: str, value: str) -> str:
    return f"""vals AS (SELECT {value} AS v {source}), e AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
c AS (SELECT least(CAST(floor(40 * (v - lo) / (hi - lo)) AS INTEGER) + 1, 40) AS bin, count(*) AS n FROM vals, e
  GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * ((hi - lo) / 40), 6) AS bin_start,
  round(lo + i * ((hi - lo) / 40), 6) AS bin_end, coalesce(n, 0) AS count
FROM range(1, 41) r(i) LEFT JOIN c ON bin = i, e"""


def _bins(h: DataFrame) -> DataFrame:
    return h.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query(f"{S}, {_histogram(_YEARLY, 'salary_min')}")
def salary_histogram(t: Tables) -> DataFrame:
    return _bins(gold.salary_histogram(t.silver_of("salary_min", "salary_period")))


@query(f"WITH {_histogram('FROM lineitem', 'l_extendedprice')}")
def histogram(t: Tables) -> DataFrame:
    return _bins(quantiles.histogram(t.lineitem, "l_extendedprice", 40))


@query(
    f"{S} SELECT strftime(date_trunc('week', posted_at), '%Y-%m-%d') AS week_start, count(*) AS job_count, "
    "count(*) FILTER (WHERE is_remote) AS remote_count FROM silver WHERE posted_at IS NOT NULL GROUP BY 1"
)
def weekly_trends(t: Tables) -> DataFrame:
    return gold.weekly_trends(t.silver_of("posted_at", "is_remote")).withColumn("week_start", F.col("week_start").cast("string"))


@query(
    "SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start, count(*) AS job_count, "
    "count(*) FILTER (WHERE event_type = 'signup') AS remote_count FROM events GROUP BY 1"
)
def weekly_counts(t: Tables) -> DataFrame:
    weeks = aggregates.weekly_counts(t.events, "ts", F.col("event_type") == "signup")
    return weeks.withColumn("week_start", F.col("week_start").cast("string"))


@query("SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY 1")
def value_counts(t: Tables) -> DataFrame:
    return aggregates.value_counts(t.documents, "lang")


@query(f"{S} SELECT location_city, count(*) AS count FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 40")
def value_counts_with_null(t: Tables) -> DataFrame:
    """Null counts as a value; only the most frequent values."""
    return aggregates.value_counts(t.silver_of("location_city"), "location_city", keep_null=True, n=40)


@query("SELECT count(DISTINCT l_partkey) AS n_distinct FROM lineitem")
def distinct_count(t: Tables) -> DataFrame:
    return aggregates.distinct_count(t.lineitem, "l_partkey")


@query(
    f"{S} SELECT location_state, count(*) AS count, CAST(round_even(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) "
    "AS DOUBLE) AS share FROM silver WHERE location_state IS NOT NULL GROUP BY 1"
)
def share_of_total(t: Tables) -> DataFrame:
    return gold.province_share(t.silver_of("location_state"))


@query("SELECT lang, source, count(*) AS count FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2")
def count_pairs(t: Tables) -> DataFrame:
    return aggregates.count_pairs(t.documents, "lang", "source")


_TAGGED = "tagged AS (SELECT job_id, seniority, unnest(skills_tags) AS skill FROM silver)"
_CATEGORY = oracle.case_map("skill", lookups.TAG_CATEGORY, "'Other'")
_DISPLAY = oracle.case_map("skill", lookups.TAG_DISPLAY, "skill")
_FREQ = f"""{_TAGGED}, freq AS (
  SELECT skill, count(*) AS count,
    CAST(round_even(count(*)::DOUBLE / (SELECT count(*) FROM silver) * 100, 1) AS DOUBLE) AS pct,
    {_CATEGORY} AS category, {_DISPLAY} AS display_name
  FROM tagged WHERE skill <> '' GROUP BY 1)"""


@query(f"{S}, {_FREQ} SELECT * FROM freq")
def skill_frequency(t: Tables) -> DataFrame:
    return gold.skill_frequency(t.silver_of("skills_tags"))


@query(f"{S}, {_FREQ} SELECT * FROM freq WHERE category = 'Modeling' ORDER BY count DESC, skill LIMIT 10")
def top_skills(t: Tables) -> DataFrame:
    return gold.skill_frequency(t.silver_of("skills_tags"), "Modeling", 10)


@query(
    f"{S}, {_FREQ}, t AS (SELECT * FROM freq ORDER BY count DESC, skill LIMIT 25) SELECT *, "
    "round(pct / max(pct) OVER () * 100, 6) AS width FROM t"
)
def skill_bars(t: Tables) -> DataFrame:
    return gold.skill_bars(t.silver_of("skills_tags")).withColumn("width", F.round("width", 6))


@query(
    f"{S}, {_FREQ}, t AS (SELECT * FROM freq WHERE category = 'Analytics' ORDER BY count DESC, skill LIMIT 25) SELECT "
    f"{len(lookups.TAG_CATEGORIES['Analytics'])} AS skills_tracked, count(*) AS skills_found, "
    "first(display_name ORDER BY count DESC, skill) AS top_skill, "
    "format('{:.1f}%', first(pct ORDER BY count DESC, skill)) AS top_pct FROM t"
)
def skill_kpis(t: Tables) -> DataFrame:
    return gold.skill_kpis(t.silver_of("skills_tags"), "Analytics")


@query(
    f"{S.replace('silver AS MATERIALIZED (', 'every AS MATERIALIZED (')}, silver AS (SELECT * FROM every WHERE posted_at >= TIMESTAMP '1996-01-01' "
    f"AND location_state = 'Ontario' AND seniority = 'Senior'), {_FREQ} SELECT * FROM freq"
)
def filtered_skill_frequency(t: Tables) -> DataFrame:
    """Tags of postings chosen by time, province and level; the percentages refer to those postings."""
    chosen = gold.skill_selection(t.silver_of("skills_tags", "posted_at", "location_state", "seniority"), "Ontario", "Senior", start=datetime(1996, 1, 1))
    return gold.skill_frequency(chosen)


@query(
    f"{S}, {_TAGGED}, top15 AS (SELECT skill FROM tagged GROUP BY skill ORDER BY count(*) DESC, skill LIMIT 15), "
    "levels AS (SELECT DISTINCT seniority FROM tagged JOIN top15 USING (skill) WHERE seniority IS NOT NULL) "
    f"SELECT seniority, CAST(CASE seniority {_ORDER} END AS INTEGER) AS ord, skill, count(job_id) AS count "
    "FROM levels CROSS JOIN top15 LEFT JOIN tagged USING (seniority, skill) GROUP BY seniority, skill"
)
def skills_by_seniority(t: Tables) -> DataFrame:
    """The 15 most frequent tags, as the data has them, by level."""
    return gold.skills_by_seniority_rows(t.silver_of("skills_tags", "seniority"))


@query(f"{S} SELECT job_id, unnest(skills_tags) AS skill FROM silver")
def explode_tags(t: Tables) -> DataFrame:
    return t.silver_of("job_id", "skills_tags").select("job_id", F.explode("skills_tags").alias("skill"))


@query(
    f"{S} SELECT DISTINCT seniority, CAST(CASE seniority {_ORDER} END AS INTEGER) AS ord FROM silver "
    "WHERE seniority IS NOT NULL"
)
def pick_list(t: Tables) -> DataFrame:
    return gold.pick_list(t.silver_of("seniority"), "seniority")


# --- quality profile ------------------------------------------------------------------------------------------------

_FLIPPED = "salary_min <> 0 AND salary_max <> 0 AND salary_min > salary_max"


def _count(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _counted(condition: str, name: str) -> str:
    return f"{_count(condition)} AS {name}, {_pct(_count(condition), 'count(*)')} AS {name}_pct"


_ODD = "regexp_matches(title, '[\\p{S}]|[^\\x00-\\x7F]')"


@query(
    f"{S} SELECT count(*) AS total_rows, "
    + ", ".join(
        [
            _counted("coalesce(location_state, '') = ''", "null_state"),
            _counted("coalesce(location_city, '') = ''", "null_city"),
            _counted("salary_min IS NOT NULL", "has_min"),
            _counted("salary_max IS NOT NULL", "has_max"),
            f"{_count(_FLIPPED)} AS flipped_pay",
            f"{_count('salary_min <> 0 AND salary_min < 200')} AS low_pay",
            f"{_count(_ODD)} AS odd_titles",
            _counted("years_experience_min IS NULL", "null_years"),
            _counted("coalesce(len(skills_tags), 0) = 0", "no_tags"),
        ]
    )
    + " FROM silver"
)
def profile_summary(t: Tables) -> DataFrame:
    return quality.profile_summary(t.silver_of("location_state", "location_city", "salary_min", "salary_max", "title", "years_experience_min", "skills_tags"))


_SOURCE = "CASE WHEN contains(job_id, '_') THEN split_part(job_id, '_', 1) ELSE 'jsearch' END"
_TABLES = " UNION ALL ".join(
    f"SELECT * FROM (SELECT {quote(f)} AS field, CAST({_SOURCE if f == 'source' else f} AS VARCHAR) AS value, count(*) AS "
    f"count, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({_SOURCE if f == 'source' else f} AS VARCHAR) NULLS FIRST) "
    f"AS INTEGER) AS place FROM silver GROUP BY 2) WHERE place <= {n}"
    for f, n in quality.FREQUENCY_FIELDS.items()
)


@query(f"{S} {_TABLES}")
def profile_frequencies(t: Tables) -> DataFrame:
    return quality.profile_frequencies(t.silver_of("job_id", *(f for f in quality.FREQUENCY_FIELDS if f != "source")))


@query(f"{S} SELECT {_SOURCE} AS source, count(*) AS count FROM silver GROUP BY 1")
def source_distribution(t: Tables) -> DataFrame:
    return quality.source_distribution(t.silver_of("job_id"))


@query(
    f"{S} SELECT job_id, salary_min, salary_max, salary_currency FROM silver WHERE salary_min <> 0 AND salary_min < 200 "
    "ORDER BY job_id LIMIT 10"
)
def low_pay_rows(t: Tables) -> DataFrame:
    return quality.low_pay_rows(t.silver_of("job_id", "salary_min", "salary_max", "salary_currency"))


@query(f"{S} SELECT job_id, title FROM silver WHERE {_ODD} ORDER BY job_id LIMIT 20")
def odd_titles(t: Tables) -> DataFrame:
    return quality.odd_titles(t.silver_of("job_id", "title"))


@query(f"{S}, {_TAGGED} SELECT skill, count(*) AS count FROM tagged GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30")
def top_tags(t: Tables) -> DataFrame:
    return quality.top_tags(t.silver_of("skills_tags"))
