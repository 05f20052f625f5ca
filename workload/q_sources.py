"""Source mappings, readers and the text and attribute functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework import lookups, schemas
from sluicework.functions import lookup as L
from sluicework.functions import normalize as N
from sluicework.functions import text as X
from sluicework.operators import filters, names
from sluicework.plans import silver as S
from sluicework.sources import mappings, readers
from workload import derive, oracle
from workload.registry import query
from workload.tables import Tables

RAW = ", ".join(["job_id", *schemas.RAW_FIELDS])


def payload(t: Tables, name: str) -> DataFrame:
    """Landed pages of one source: JSON texts built from the feed, in folders by year of the posting."""
    f = t.feed.filter(F.col("feed") == name)
    key = F.col("k").cast("string")
    area = F.array(F.col("country"), F.col("state"), F.lit("Region"), F.col("city"))
    area = F.when(F.col("depth") < 3, F.slice(area, 1, F.col("depth").cast("int"))).otherwise(area)
    items = {
        "jsearch": F.struct(
            key.alias("job_id"), F.col("title").alias("job_title"), F.col("company").alias("employer_name"),
            F.col("site").alias("employer_website"), F.col("city").alias("job_city"),
            F.col("state").alias("job_state"), F.col("country").alias("job_country"),
            F.col("remote").alias("job_is_remote"), F.col("kind").alias("job_employment_type"),
            F.col("low").alias("job_min_salary"), F.col("high").alias("job_max_salary"),
            F.col("currency").alias("job_salary_currency"), F.col("period").alias("job_salary_period"),
            F.col("description").alias("job_description"), F.col("link").alias("job_apply_link"),
            F.col("logo").alias("employer_logo"), F.col("iso").alias("job_posted_at_datetime_utc"),
        ),
        "adzuna": F.struct(
            key.alias("id"), "title", F.struct(F.col("company").alias("display_name")).alias("company"),
            F.struct(area.alias("area")).alias("location"), "description", F.col("link").alias("redirect_url"),
            F.col("low").alias("salary_min"), F.col("high").alias("salary_max"), F.col("kind").alias("contract_time"),
            F.col("iso").alias("created"),
        ),
        "theirstack": F.struct(
            key.alias("id"), F.col("title").alias("job_title"), F.col("company").alias("company_name"),
            F.col("site").alias("company_url"), F.col("logo").alias("company_logo"), "city", "state", "country",
            "remote", F.col("kind").alias("employment_type"), F.col("low").alias("salary_min"),
            F.col("high").alias("salary_max"), F.col("currency").alias("salary_currency"),
            F.col("period").alias("salary_period"), "description", F.col("link").alias("url"),
            F.col("iso").alias("date_posted"),
        ),
        "serpapi": F.struct(
            key.alias("job_id"), "title", F.col("company").alias("company_name"), F.col("place").alias("location"),
            "description", F.col("logo").alias("thumbnail"),
            F.when(F.col("link").isNull(), F.array().cast("array<struct<link:string,title:string>>"))
            .otherwise(F.array(F.struct("link", F.lit("Apply").alias("title")))).alias("apply_options"),
            F.struct(
                F.col("kind").alias("schedule_type"), F.col("remote").alias("work_from_home"),
                F.col("ago").alias("posted_at"), F.col("pay_text").alias("salary"),
            ).alias("detected_extensions"),
        ),
    }
    envelope = {"jsearch": "data", "adzuna": "results", "theirstack": "data", "serpapi": "jobs_results"}[name]
    page = F.year("o_orderdate") - 1991
    return f.select(page.alias("page"), F.to_json(F.struct(F.array(items[name]).alias(envelope))).alias("value"))


def pages(t: Tables, name: str) -> DataFrame:
    """The payload texts parsed with the source's fixed schema."""
    schema = mappings.sources()[name].page_ddl
    return payload(t, name).select("page", F.inline(F.array(F.from_json("value", schema))))


for _name in ("jsearch", "adzuna", "theirstack", "serpapi"):

    def _mapped(t: Tables, name: str = _name) -> DataFrame:
        return mappings.sources()[name].mapping(pages(t, name)).select("job_id", *schemas.RAW_FIELDS)

    query(f"WITH {oracle.BRONZE} SELECT {RAW} FROM bronze WHERE feed = '{_name}'", f"map_{_name}")(_mapped)

_RANK = "CASE feed WHEN 'jsearch' THEN 0 WHEN 'adzuna' THEN 1 WHEN 'theirstack' THEN 2 ELSE 3 END"


@query(
    f"WITH {oracle.BRONZE} SELECT {RAW}, feed AS source, {_RANK} AS source_rank, "
    "CAST(year(o_orderdate) - 1991 AS INTEGER) AS page FROM bronze"
)
def ingest_bronze(t: Tables) -> DataFrame:
    """All sources read from landed JSON files; a source whose folder does not exist is skipped."""
    rows = _landed(t)
    return rows.select(
        "job_id", *schemas.RAW_FIELDS, "source", F.col("arrival.source_rank"), F.col("arrival.page")
    )


def planted(t: Tables) -> DataFrame:
    """Pages of one source, with lines that are cut short, error messages, and records without an id among them."""
    good = payload(t, "theirstack")
    cut = t.nation.select((F.col("n_regionkey") + 1).cast("int").alias("page"), F.concat(F.lit('{"data": [{"id": "'), "n_name").alias("value"))
    errors = t.region.select((F.col("r_regionkey") + 1).cast("int").alias("page"), F.to_json(F.struct(F.col("r_name").alias("error"))).alias("value"))
    nameless = F.to_json(F.struct(F.array(F.struct(F.col("s_name").alias("job_title"))).alias("data")))
    without = t.supplier.select((F.col("s_nationkey") % 7 + 1).cast("int").alias("page"), nameless.alias("value"))
    return good.select(F.col("page").cast("int").alias("page"), "value").unionByName(cut).unionByName(errors).unionByName(without)


@query(
    "SELECT 'theirstack' AS source, CAST(n_regionkey + 1 AS INTEGER) AS page, 'broken line' AS reason, "
    """'{"data": [{"id": "' || n_name AS text, 1::BIGINT AS records FROM nation UNION ALL """
    "SELECT 'theirstack', CAST(r_regionkey + 1 AS INTEGER), 'no records', "
    """'{"error":"' || r_name || '"}', 1::BIGINT FROM region UNION ALL """
    "SELECT 'theirstack', CAST(s_nationkey % 7 + 1 AS INTEGER), 'no id', NULL, count(*)::BIGINT FROM supplier GROUP BY 2"
)
def ingest_rejects(t: Tables) -> DataFrame:
    """What the reader of landed pages leaves out: as many lines and records as were planted."""
    path = t.stored("landing_planted", lambda: planted(t), "text", "page")
    return readers.read_rejects(t.spark, path, mappings.sources()["theirstack"])


def _landed(t: Tables, max_pages: int | None = None) -> DataFrame:
    paths = {
        name: t.stored(f"landing_{name}", lambda n=name: payload(t, n), "text", "page") for name in mappings.sources()
    }
    return readers.ingest_bronze(t.spark, paths, t.as_of, max_pages)


@query(
    f"WITH {oracle.BRONZE} SELECT feed AS source, CAST(year(o_orderdate) - 1991 AS INTEGER) AS page, "
    "count(*) AS n FROM bronze WHERE year(o_orderdate) - 1991 <= 5 GROUP BY 1, 2"
)
def limit_pages(t: Tables) -> DataFrame:
    """The first pages of every crawl; the page number is a folder, so other files are not opened."""
    rows = _landed(t, max_pages=5)
    return rows.groupBy("source", F.col("arrival.page").alias("page")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {oracle.BRONZE} SELECT job_id, feed AS source FROM bronze")
def source_of(t: Tables) -> DataFrame:
    return t.bronze.select("job_id", readers.source_of(F.col("job_id")).alias("source"))


@query("SELECT * FROM customer")
def scan_table(t: Tables) -> DataFrame:
    return readers.scan(t.spark, f"{t.folder}/customer.parquet")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def scan_columns(t: Tables) -> DataFrame:
    return readers.scan(t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query(f"WITH {oracle.FEED} SELECT k, place_city AS city, place_state AS province, place_country AS country FROM feed")
def split_location(t: Tables) -> DataFrame:
    """Checked against the parts that the text was built from."""
    return t.feed.select("k", F.inline(F.array(N.split_location(F.col("place")))))


@query(
    f"WITH {oracle.FEED} SELECT k, CASE WHEN depth > 2 THEN city END AS city, CASE WHEN depth > 1 THEN state END AS "
    "province, CASE WHEN depth > 0 THEN country ELSE 'Canada' END AS country FROM feed"
)
def split_area(t: Tables) -> DataFrame:
    area = F.array(F.col("country"), F.col("state"), F.lit("Region"), F.col("city"))
    area = F.when(F.col("depth") < 3, F.slice(area, 1, F.col("depth").cast("int"))).otherwise(area)
    return t.feed.select("k", area.alias("area")).select("k", F.inline(F.array(N.split_area(F.col("area")))))


@query(f"WITH {oracle.FEED} SELECT k, pay_low AS low, pay_high AS high, pay_period AS period FROM feed")
def parse_pay(t: Tables) -> DataFrame:
    """Range, amounts and period of a pay text, checked against the numbers it was built from."""
    text = F.col("pay_text")
    return t.feed.select(
        "k", F.inline(F.array(N.parse_salary_range(text))), N.parse_salary_period(text).alias("period"), "pay_text"
    ).select("k", "low", "high", "period")


@query(f"SELECT page_id, {oracle.domain('url')} AS domain FROM pages")
def normalize_domain(t: Tables) -> DataFrame:
    return t.pages.select("page_id", N.normalize_domain(F.col("url")).alias("domain"))


@query(f"SELECT {oracle.domain('url')} AS domain, count(*) AS count FROM pages GROUP BY 1")
def pages_per_domain(t: Tables) -> DataFrame:
    return t.pages.groupBy(N.normalize_domain(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).alias("count"))


@query(f"SELECT page_id, {oracle.clean_html('html')} AS text FROM pages")
def clean_html(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.clean_html(F.col("html")).alias("text"))


@query("SELECT doc_id, md5(strip_accents(text)) AS digest, length(strip_accents(text)) AS n FROM documents")
def strip_accents(t: Tables) -> DataFrame:
    plain = t.documents.select("doc_id", X.strip_accents(F.col("text")).alias("p"))
    return plain.select("doc_id", F.md5("p").alias("digest"), F.length("p").cast("bigint").alias("n"))


WORDS = ["the", "and", "of", "that", "les", "que", "est", "et", "pour", "der", "und", "nicht", "de", "la", "el", "con"]
_TOKENS = "string_split_regex(lower(text), '[^\\p{L}\\p{N}\\p{M}_]+')"


@query(
    f"SELECT doc_id, array_to_string(list_filter({sorted(WORDS)}, lambda w: list_contains({_TOKENS}, w)), '|') AS tags "
    "FROM documents"
)
def extract_tags(t: Tables) -> DataFrame:
    """Tags from a taxonomy given as a parameter, over whole documents."""
    return t.documents.select("doc_id", F.array_join(X.extract_tags(F.col("text"), WORDS), "|").alias("tags"))


@query(
    f"WITH terms AS (SELECT DISTINCT unnest({_TOKENS}) AS t FROM benchmark), words AS (SELECT DISTINCT doc_id, unnest({_TOKENS}) AS t "
    "FROM documents) SELECT doc_id, coalesce(string_agg(terms.t, '|' ORDER BY encode(terms.t)) FILTER (WHERE terms.t <> ''), '') AS tags "
    "FROM (SELECT doc_id FROM documents) LEFT JOIN words USING (doc_id) LEFT JOIN terms USING (t) GROUP BY doc_id"
)
def extract_terms(t: Tables) -> DataFrame:
    """Tags from a taxonomy that is a table itself: all words of the benchmark, over whole documents."""
    words = t.benchmark.select(F.explode(F.split(F.lower("text"), r"(?U)\W+")).alias("term")).distinct()
    found = names.extract_terms(t.documents, words.withColumn("order", F.lit(0)), "doc_id", "text")
    return found.select("doc_id", F.array_join("tags", "|").alias("tags"))


@query(
    "SELECT doc_id, regexp_matches(text, '[\\p{S}]|[^\\x00-\\x7F]') AS odd, lang FROM documents"
)
def has_odd_characters(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.has_odd_characters(F.col("text")).alias("odd"), "lang")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def nested_json(t: Tables) -> DataFrame:
    """A field of a JSON text, null where it is absent."""
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query(f"WITH {oracle.SILVER} SELECT job_id, {oracle.years('job_description')} AS years FROM silver")
def extract_years(t: Tables) -> DataFrame:
    return t.silver_of("job_id", "job_description").select("job_id", X.extract_years(F.col("job_description")).alias("years"))


@query(f"WITH {oracle.SILVER} SELECT job_id, seniority FROM silver")
def classify_by_rules(t: Tables) -> DataFrame:
    return t.silver_of("job_id", "title", "years_experience_min").select(
        "job_id", X.classify_by_rules(F.col("title"), F.col("years_experience_min")).alias("seniority")
    )


@query(f"WITH {oracle.BRONZE} SELECT job_id, {oracle.province('location_state_raw')} AS province FROM bronze")
def normalize_province(t: Tables) -> DataFrame:
    return t.bronze.select("job_id", N.normalize_province(F.col("location_state_raw")).alias("province"))


@query(f"WITH {oracle.BRONZE} SELECT job_id, {oracle.city('location_city_raw')} AS city FROM bronze")
def normalize_city(t: Tables) -> DataFrame:
    return t.bronze.select("job_id", N.normalize_city(F.col("location_city_raw")).alias("city"))


@query(f"WITH {oracle.BRONZE} SELECT job_id, {oracle.country('location_country_raw')} AS country FROM bronze")
def normalize_country(t: Tables) -> DataFrame:
    return t.bronze.select("job_id", N.normalize_country(F.col("location_country_raw")).alias("country"))


@query(f"WITH {oracle.BRONZE} SELECT job_id, {oracle.employment('employment_type_raw')} AS kind FROM bronze")
def normalize_employment_type(t: Tables) -> DataFrame:
    return t.bronze.select("job_id", N.normalize_employment_type(F.col("employment_type_raw")).alias("kind"))


@query(f"WITH {oracle.BRONZE} SELECT job_id, {oracle.city_province('location_city_raw')} AS province FROM bronze")
def province_of_city(t: Tables) -> DataFrame:
    return t.bronze.select("job_id", N.province_of_city(F.col("location_city_raw")).alias("province"))


_FOUND = oracle.text_city("job_description")
_PLACES = (
    f"WITH {oracle.SILVER}, hit AS (SELECT job_id, {_FOUND} AS found, {oracle.text_code('job_description')} AS code "
    f"FROM silver) SELECT job_id, {oracle.case_map('found', oracle._CITIES, 'NULL')} AS city, CASE WHEN found IS NULL "
    f"THEN code ELSE {oracle.case_map('found', oracle.lookups.CITY_PROVINCES, 'NULL')} END AS province FROM hit"
)


@query(_PLACES)
def locate(t: Tables) -> DataFrame:
    """The same from a table of cities."""
    cities = [(c, lookups.city_display(c), p, i) for i, (c, p) in enumerate(lookups.CITY_PROVINCES.items())]
    table = t.spark.createDataFrame(cities, "name string, city string, province string, order int")
    return names.locate(t.silver_of("job_id", "job_description"), table, "job_id", "job_description")


@query(_PLACES)
def infer_location_from_text(t: Tables) -> DataFrame:
    found = t.silver_of("job_id", "job_description").select("job_id", X.infer_location_from_text(F.col("job_description")).alias("f"))
    return found.select("job_id", "f.city", "f.province")


@query(
    f"WITH {oracle.SILVER} SELECT job_id, location_city, location_state FROM silver"
)
def resolve_location(t: Tables) -> DataFrame:
    """Places in fill order: normalised, city's province, text."""
    rows = t.silver_of("job_id", "location_city_raw", "location_state_raw", "job_description").select(
        "job_id",
        F.col("location_city_raw").alias("location_city"),
        F.col("location_state_raw").alias("location_state"),
        "job_description",
    )
    return S.resolve_location(rows).select("job_id", "location_city", "location_state")


@query(f"WITH {oracle.SILVER} SELECT job_id, salary_min, salary_max, salary_period FROM silver")
def annualize(t: Tables) -> DataFrame:
    period = F.col("salary_period_raw")
    return t.bronze.select(
        "job_id",
        N.annualize(F.col("salary_min_raw"), period).alias("salary_min"),
        N.annualize(F.col("salary_max_raw"), period).alias("salary_max"),
        N.annual_period(period).alias("salary_period"),
    )


@query(
    f"WITH {oracle.FEED} SELECT k, strftime({oracle.relative('ago', derive.AS_OF)}, '%Y-%m-%d %H:%M:%S') AS at FROM feed"
)
def relative_to_timestamp(t: Tables) -> DataFrame:
    at = N.relative_to_timestamp(F.col("ago"), t.as_of)
    return t.feed.select("k", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    f"WITH {oracle.FEED} SELECT k, strftime(TRY_CAST(replace(iso, 'Z', '') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS at, "
    "TRY_CAST(CASE WHEN feed = 'jsearch' THEN period ELSE CAST(k % 100 AS VARCHAR) END AS DOUBLE) AS number FROM feed"
)
def coerce_values(t: Tables) -> DataFrame:
    """Texts to times and numbers; what cannot be read is null."""
    text = F.when(F.col("feed") == "jsearch", F.col("period")).otherwise((F.col("k") % 100).cast("string"))
    at = F.date_format(N.coerce_timestamp(F.col("iso")), "yyyy-MM-dd HH:mm:ss")
    return t.feed.select("k", at.alias("at"), N.coerce_number(text).alias("number"))


@query(f"WITH {oracle.SILVER} SELECT job_id, strftime(posted_at, '%Y-%m-%d %H:%M:%S') AS posted_at FROM silver")
def parse_posted_at(t: Tables) -> DataFrame:
    at = N.parse_posted_at(F.col("posted_at_raw"), t.as_of)
    return t.bronze.select("job_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("posted_at"))


@query(f"WITH {oracle.SILVER} SELECT job_id, is_remote FROM silver")
def infer_flag_from_text(t: Tables) -> DataFrame:
    flag = X.infer_flag_from_text(F.col("is_remote_raw"), F.col("job_description"))
    return t.silver_of("job_id", "is_remote_raw", "job_description").select("job_id", flag.alias("is_remote"))


@query(
    "SELECT o_orderkey, format('{:,}', CAST(trunc(o_totalprice) AS BIGINT)) AS thousands, "
    "'$' || format('{:,}', CAST(round_even(o_totalprice / 1000, 0) AS BIGINT)) || 'k' AS short, "
    "CASE WHEN o_orderstatus = 'P' THEN '—' ELSE CAST(round_even(o_orderkey % 1000 / 10, 0) AS BIGINT) || '%' END "
    "AS rate FROM orders"
)
def display_numbers(t: Tables) -> DataFrame:
    """Thousands, short money and percent texts, with a dash for null."""
    rate = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") % 1000 / 10)
    return t.orders.select(
        "o_orderkey",
        L.display_count(F.col("o_totalprice")).alias("thousands"),
        L.display_thousands(F.col("o_totalprice")).alias("short"),
        L.display_percent(rate).alias("rate"),
    )


@query(
    "SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '), "
    "lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM part"
)
def title_case(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", L.title_case(F.col("p_name")).alias("title"))


_COPY = ", ".join(
    "coalesce(is_remote_raw, false) AS is_remote" if f == "is_remote"
    else "coalesce(nullif(salary_currency_raw, ''), 'CAD') AS salary_currency" if f == "salary_currency"
    else f"{f}_raw AS {f}"
    for f in schemas.FIELDS
)


@query(f"WITH {oracle.BRONZE} SELECT job_id, {_COPY} FROM bronze")
def copy_to_silver(t: Tables) -> DataFrame:
    return S.copy_to_silver(t.bronze).select("job_id", *schemas.FIELDS)


_PLAIN = [f for f in schemas.FIELDS if f != "posted_at"]
SILVER_OUT = ", ".join(
    ["job_id", *_PLAIN, "years_experience_min", "seniority"]
    + ["strftime(posted_at, '%Y-%m-%d %H:%M:%S') AS posted_at", "array_to_string(skills_tags, '|') AS skills_tags"]
)


def silver_output(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        *more,
        "job_id", *_PLAIN, "years_experience_min", "seniority",
        F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss").alias("posted_at"),
        F.array_join("skills_tags", "|").alias("skills_tags"),
    )


@query(f"WITH {oracle.SILVER} SELECT {SILVER_OUT} FROM silver")
def to_silver(t: Tables) -> DataFrame:
    """The whole Bronze to Silver transform."""
    return silver_output(S.to_silver(t.bronze, t.as_of))


@query(f"WITH {oracle.SILVER} SELECT {SILVER_OUT} FROM silver")
def backfill_silver(t: Tables) -> DataFrame:
    """Stored rows transformed again: Bronze fallback, then Silver with the same instant gives the same rows."""
    stored = t.silver_of("job_id", *schemas.FIELDS, *schemas.RAW_FIELDS)
    return silver_output(S.to_silver(S.bronze_fallback(stored), t.as_of))


_FALLBACK = ", ".join(
    "coalesce(posted_at_raw, strftime(posted_at, '%Y-%m-%d %H:%M:%S')) AS posted_at_raw" if f == "posted_at"
    else f"coalesce({f}_raw, {f}) AS {f}_raw"
    for f in schemas.FIELDS
)


@query(f"WITH {oracle.SILVER} SELECT job_id, {_FALLBACK} FROM silver")
def bronze_fallback(t: Tables) -> DataFrame:
    return S.bronze_fallback(t.silver_of("job_id", *schemas.FIELDS, *schemas.RAW_FIELDS)).select("job_id", *schemas.RAW_FIELDS)


_COMPARED = ["title", "location_city", "salary_min", "is_remote"]


@query(
    f"WITH {oracle.SILVER} SELECT job_id, "
    + ", ".join(f"{f}, {f}_raw, {f} IS DISTINCT FROM {f}_raw AS {f}_changed" for f in _COMPARED)
    + " FROM silver"
)
def raw_against_silver(t: Tables) -> DataFrame:
    return filters.raw_against_silver(t.silver_of("job_id", *_COMPARED, *(f"{f}_raw" for f in _COMPARED)), _COMPARED)
