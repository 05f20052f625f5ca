"""Filters, ordering, deduplication, merging and constraint checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.operators import dedup, filters, joins, merge, quality
from sluicework.operators.keyed import KeyedTable
from sluicework.session import working_folder
from workload import derive, oracle
from workload.registry import query
from workload.tables import Tables

# --- filters and ordering -------------------------------------------------------------------------------------------

EVENTS_AS_OF = "2024-01-25 00:00:00"


@query("SELECT event_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-18 00:00:00'")
def since_days(t: Tables) -> DataFrame:
    """Rows of the last 7 days before a given instant."""
    as_of = F.lit(EVENTS_AS_OF).cast("timestamp_ntz")
    return filters.since(t.events, "ts", as_of, days=7).select("event_id", "event_type", "value")


@query("SELECT event_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'")
def since_start(t: Tables) -> DataFrame:
    """Rows from a fixed date on."""
    start = F.lit("2024-01-10").cast("timestamp_ntz")
    return filters.since(t.events, "ts", start=start).select("event_id", "event_type", "value")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def apply_filters(t: Tables) -> DataFrame:
    """One column filtered, the other left at 'all'."""
    choices = {"o_orderstatus": "F", "o_orderpriority": "All"}
    return filters.apply_filters(t.orders, choices, "All").select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def one_of(t: Tables) -> DataFrame:
    return filters.one_of(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey", "o_orderpriority")


@query(f"WITH {oracle.SILVER} SELECT job_id, location_state, salary_min FROM silver WHERE location_state IS NOT NULL AND salary_min IS NOT NULL")
def known(t: Tables) -> DataFrame:
    return filters.known(t.silver_of("job_id", "location_state", "salary_min"), "location_state", "salary_min").select("job_id", "location_state", "salary_min")


@query(f"WITH {oracle.SILVER} SELECT job_id, salary_min FROM silver WHERE salary_min IS NOT NULL AND salary_period = 'YEAR'")
def annual_pay(t: Tables) -> DataFrame:
    return filters.annual_pay(t.silver_of("job_id", "salary_min", "salary_period")).select("job_id", "salary_min")


@query(f"WITH {oracle.SILVER} SELECT job_id, company_name FROM silver WHERE regexp_matches(company_name, '(?i)house.*_1\\d')")
def search(t: Tables) -> DataFrame:
    return filters.search(t.silver_of("job_id", "company_name"), "company_name", r"house.*_1\d").select("job_id", "company_name")


@query("SELECT c_custkey AS customer, c_name AS name FROM customer")
def rename_existing(t: Tables) -> DataFrame:
    """Only the wanted columns that exist, under new names."""
    kept = filters.existing_columns(t.customer, ["c_custkey", "c_phone", "c_name"])
    return filters.rename(kept, {"c_custkey": "customer", "c_name": "name"})


@query("SELECT doc_id, lang FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '#7'), doc_id LIMIT 10")
def sample_rows(t: Tables) -> DataFrame:
    return filters.sample_rows(t.documents.select("doc_id", "lang"), "doc_id", 10, seed=7)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_n(t: Tables) -> DataFrame:
    return filters.top_n(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 20, ["o_orderkey"])


_PRIORITIES = ["3-MEDIUM", "1-URGENT", "9-NONE", "5-LOW"]


@query(
    "SELECT o_orderpriority, count(*) AS count, CASE o_orderpriority WHEN '3-MEDIUM' THEN 0 WHEN '1-URGENT' THEN 1 "
    "ELSE 3 END AS ord FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '1-URGENT', '5-LOW') GROUP BY 1, 3"
)
def in_order(t: Tables) -> DataFrame:
    """Counts in a given order; values outside the order drop out."""
    return filters.in_order(joins.count_values(t.orders, "o_orderpriority"), "o_orderpriority", _PRIORITIES)


@query(
    "SELECT DISTINCT o_orderpriority, CASE o_orderpriority WHEN '3-MEDIUM' THEN 0 WHEN '1-URGENT' THEN 1 "
    "WHEN '5-LOW' THEN 3 ELSE 4 END AS ord FROM orders"
)
def listed_first(t: Tables) -> DataFrame:
    return filters.listed_first(t.orders.select("o_orderpriority").distinct(), "o_orderpriority", _PRIORITIES)


@query("SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL ORDER BY 1")
def distinct_sorted(t: Tables) -> DataFrame:
    return filters.distinct_sorted(t.events, "event_type")


# --- deduplication --------------------------------------------------------------------------------------------------


@query(
    "SELECT user_id, event_id, event_type, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1"
)
def first_per_key(t: Tables) -> DataFrame:
    """First event of each user; few users hold all events, so every key is hot."""
    return dedup.first_per_key(t.events.select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


@query(
    "SELECT user_id, event_id, event_type, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"
)
def last_per_key(t: Tables) -> DataFrame:
    return dedup.last_per_key(t.events.select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


_SPLIT = "1997-01-01"


def history(t: Tables) -> DataFrame:
    """Orders stored by earlier runs."""
    return t.orders.filter(F.col("o_orderdate") < F.lit(_SPLIT).cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("note"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def batch(t: Tables) -> DataFrame:
    """The incoming feed: every line of every order, so that most keys come several times."""
    order = F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("price"),
        order.alias("arrival"),
    )


_HISTORY = (
    "target AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS note, "
    f"o_orderdate AS created_at, o_orderdate AS updated_at FROM orders WHERE o_orderdate < TIMESTAMP '{_SPLIT}')"
)
_BATCH = (
    "batch AS (SELECT l_orderkey AS id, l_linestatus AS status, l_extendedprice AS price, row_number() OVER "
    "(PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place "
    "FROM lineitem)"
)


@query(f"WITH {_HISTORY}, {_BATCH} SELECT id, status, price FROM batch WHERE id NOT IN (SELECT id FROM target)")
def filter_new(t: Tables) -> DataFrame:
    """Incoming rows with unknown keys; copies stay."""
    return dedup.filter_new(batch(t), history(t), "id").drop("arrival")


@query(f"WITH {_HISTORY}, {_BATCH} SELECT id, status, price FROM batch WHERE id IN (SELECT id FROM target)")
def known_rows(t: Tables) -> DataFrame:
    return dedup.known_rows(batch(t), history(t), "id").drop("arrival")


@query(f"WITH {_HISTORY}, {_BATCH} SELECT DISTINCT id FROM batch WHERE id IN (SELECT id FROM target)")
def existing_keys(t: Tables) -> DataFrame:
    return dedup.existing_keys(batch(t), history(t), "id")


@query(
    f"WITH {_HISTORY}, {_BATCH} SELECT count(*) AS incoming, count(DISTINCT id) FILTER (WHERE new) AS new, "
    "count(*) FILTER (WHERE new) - count(DISTINCT id) FILTER (WHERE new) AS duplicate, "
    "count(*) FILTER (WHERE NOT new) AS skipped FROM (SELECT id, id NOT IN (SELECT id FROM target) AS new FROM batch)"
)
def dedup_counts(t: Tables) -> DataFrame:
    return dedup.dedup_counts(batch(t), history(t), "id")


# --- merging --------------------------------------------------------------------------------------------------------

_NOW = "2024-03-12 15:00:00"


@query(
    f"WITH {_HISTORY}, {_BATCH} SELECT coalesce(b.id, t.id) AS id, CASE WHEN b.id IS NULL THEN t.status ELSE b.status "
    "END AS status, CASE WHEN b.id IS NULL THEN t.price ELSE b.price END AS price, t.note, "
    f"strftime(coalesce(t.created_at, TIMESTAMP '{_NOW}'), '%Y-%m-%d') AS created_at, "
    f"strftime(CASE WHEN b.id IS NULL THEN t.updated_at ELSE TIMESTAMP '{_NOW}' END, '%Y-%m-%d') AS updated_at "
    "FROM target t FULL JOIN (SELECT * FROM batch WHERE place = 1) b ON t.id = b.id"
)
def merge_upsert(t: Tables) -> DataFrame:
    now = F.lit(_NOW).cast("timestamp_ntz")
    merged = merge.merge_upsert(history(t), batch(t), "id", now=now)
    days = {c: F.date_format(c, "yyyy-MM-dd") for c in ("created_at", "updated_at")}
    return merged.withColumns(days)


_MERGED = (
    f"WITH {_HISTORY}, {_BATCH} SELECT coalesce(b.id, t.id) AS id, CASE WHEN b.id IS NULL THEN t.status ELSE b.status "
    "END AS status, CASE WHEN b.id IS NULL THEN t.price ELSE b.price END AS price, t.note, "
    f"strftime(coalesce(t.created_at, TIMESTAMP '{_NOW}'), '%Y-%m-%d') AS created_at, "
    f"strftime(CASE WHEN b.id IS NULL THEN t.updated_at ELSE TIMESTAMP '{_NOW}' END, '%Y-%m-%d') AS updated_at "
    "FROM target t FULL JOIN (SELECT * FROM batch WHERE place = 1) b ON t.id = b.id"
)


@query(_MERGED)
def merge_stored(t: Tables) -> DataFrame:
    """The same in a stored table, into which the batch is merged in two parts."""
    rows, new = history(t), batch(t)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    table = KeyedTable(f"{working_folder(t.spark)}/merged-{uuid.uuid4().hex}", ddl, "id", parts=16)
    first = rows.withColumn("_part", table.part(F.col("id"))).withColumnRenamed("_part", "part_of_16")
    first.repartition(8, "part_of_16").write.partitionBy("part_of_16").parquet(table.path)
    now = F.lit(_NOW).cast("timestamp_ntz")
    for half in (0, 1):
        table.merge(new.filter(F.col("id") % 2 == half), now=now)
    days = {c: F.date_format(c, "yyyy-MM-dd") for c in ("created_at", "updated_at")}
    return table.read(t.spark).withColumns(days)


@query(
    f"WITH {oracle.SILVER}, companies AS ({derive.COMPANIES}), stubs AS (SELECT company_domain AS domain, company_name "
    "AS name FROM silver WHERE company_domain IS NOT NULL QUALIFY row_number() OVER (PARTITION BY company_domain "
    "ORDER BY k DESC) = 1) SELECT domain, name, industry FROM companies UNION ALL SELECT domain, name, NULL FROM stubs "
    "WHERE domain NOT IN (SELECT domain FROM companies)"
)
def ensure_stubs(t: Tables) -> DataFrame:
    return merge.ensure_stubs(t.companies, t.silver_of("company_domain", "company_name", "k"), "k", now=t.as_of).select("domain", "name", "industry")


_CURATED = """
SELECT (CASE o_orderkey % 4 WHEN 0 THEN 'adzuna_' WHEN 1 THEN 'theirstack_' WHEN 2 THEN 'serpapi_' ELSE '' END)
    || o_orderkey AS job_id,
  'Curated ' || o_custkey AS company_name, o_totalprice AS salary_min,
  (CASE WHEN o_orderstatus = 'F' THEN 'Ottawa' END) AS location_city
FROM orders WHERE o_orderpriority = '1-URGENT'
"""
_FILLED = f"""filled AS (
  SELECT s.job_id, coalesce(s.company_name, c.company_name) AS company_name,
    coalesce(s.salary_min, c.salary_min) AS salary_min, coalesce(s.location_city, c.location_city) AS location_city,
    (s.company_name IS NULL AND c.company_name IS NOT NULL) OR (s.salary_min IS NULL AND c.salary_min IS NOT NULL)
      OR (s.location_city IS NULL AND c.location_city IS NOT NULL) AS filled
  FROM silver s LEFT JOIN ({_CURATED}) c ON s.job_id = c.job_id)"""


def _filled(t: Tables) -> DataFrame:
    columns = ["company_name", "salary_min", "location_city"]
    return joins.fill_from(t.silver_of("job_id", *columns), t.sql(_CURATED), "job_id", columns)


@query(f"WITH {oracle.SILVER}, {_FILLED} SELECT * FROM filled")
def fill_from(t: Tables) -> DataFrame:
    return _filled(t)


@query(f"WITH {oracle.SILVER}, {_FILLED} SELECT count(*) FILTER (WHERE filled) AS changed FROM filled")
def fill_count(t: Tables) -> DataFrame:
    return _filled(t).agg(F.count_if("filled").alias("changed"))


_RUN_EVENTS = """
SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS run_id, CAST(o_orderdate AS TIMESTAMP) + INTERVAL '6' HOUR AS event_at,
  'running' AS status, CAST(NULL AS BIGINT) AS jobs_fetched, CAST(NULL AS BIGINT) AS jobs_new
FROM orders GROUP BY o_orderdate
UNION ALL
SELECT CAST(CAST(o_orderdate AS DATE) AS STRING), CAST(o_orderdate AS TIMESTAMP) + INTERVAL '7' HOUR,
  CASE WHEN count(*) > 3 THEN 'success' ELSE 'failed' END, count(*), count(DISTINCT o_custkey)
FROM orders GROUP BY o_orderdate HAVING count(*) > 1
"""
_RUNS = f"""runs AS (
  SELECT run_id, strftime(first_value(event_at) OVER (PARTITION BY run_id ORDER BY event_at), '%Y-%m-%d %H:%M') AS run_at,
    status, jobs_fetched, jobs_new
  FROM ({_RUN_EVENTS}) QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY event_at DESC) = 1)"""


def _readable(runs: DataFrame) -> DataFrame:
    return runs.withColumn("run_at", F.date_format("run_at", "yyyy-MM-dd HH:mm"))


@query(f"WITH {_RUNS} SELECT * FROM runs")
def current_runs(t: Tables) -> DataFrame:
    """State of every run: one per day of orders, with a start event and, mostly, a finish event."""
    return _readable(merge.current_runs(t.sql(_RUN_EVENTS)))


@query(f"WITH {_RUNS} SELECT run_id, run_at, status, jobs_fetched FROM runs ORDER BY run_at DESC, run_id LIMIT 20")
def recent_runs(t: Tables) -> DataFrame:
    runs = _readable(merge.recent_runs(t.sql(_RUN_EVENTS), 20))
    return filters.existing_columns(runs, ["run_id", "run_at", "status", "jobs_fetched", "jobs_skipped"])


# --- constraints ----------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) > 1 OR l_orderkey IS NULL")
def key_violations(t: Tables) -> DataFrame:
    return quality.key_violations(t.lineitem, "l_orderkey")


@query(
    f"WITH {oracle.SILVER}, companies AS ({derive.COMPANIES}) SELECT job_id, company_domain FROM silver "
    "WHERE company_domain IS NOT NULL AND company_domain NOT IN (SELECT domain FROM companies)"
)
def orphans(t: Tables) -> DataFrame:
    rows = t.silver_of("job_id", "company_domain")
    return quality.orphans(rows, t.companies, "company_domain", "domain").select("job_id", "company_domain")


@query(
    f"WITH {oracle.SILVER}, companies AS ({derive.COMPANIES}) SELECT job_id, CASE WHEN company_domain IN (SELECT domain "
    "FROM companies) THEN company_domain END AS company_domain FROM silver"
)
def clear_orphans(t: Tables) -> DataFrame:
    rows = t.silver_of("job_id", "company_domain")
    return quality.clear_orphans(rows, t.companies, "company_domain", "domain")
