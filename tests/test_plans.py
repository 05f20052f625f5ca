"""Physical plans: what is pushed down, pruned, combined before a shuffle, and kept out of Python."""

from __future__ import annotations

import re
import shutil

import pytest
from pyspark.sql import functions as F

from sluicework.operators import dedup, filters, merge, quantiles
from sluicework.plans import gold
from sluicework.plans.silver import to_silver
from workload import q_gold, q_merge, q_paging, q_sources, q_stream, tables  # noqa: F401
from workload.registry import QUERIES
from workload.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def t(spark):
    return Tables(spark, FOLDER)


def test_first_per_key_sends_one_row_per_key_and_task(t):
    text = plan(dedup.first_per_key(t.events.select("user_id", "event_id", "value"), "user_id", "event_id"))
    before, after = text.split("Exchange hashpartitioning(user_id", 1)
    assert "WindowGroupLimit" in after and "Partial" in after


def test_known_keys_read_only_the_key_column(t):
    text = plan(dedup.filter_new(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), t.orders, "o_orderkey"))
    assert sorted(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == ["l_orderkey:bigint", "o_orderkey:bigint"]


def test_time_filter_reaches_the_scan(t):
    as_of = F.lit("2024-01-25").cast("timestamp_ntz")
    text = plan(filters.since(t.events, "ts", as_of, days=7).select("event_id"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-18", text)


def test_silver_runs_without_python(t):
    text = plan(to_silver(t.bronze, t.as_of))
    assert "EvalPython" not in text and "Exchange hashpartitioning" not in text


def test_province_stats_reads_four_columns_once(t):
    text = plan(gold.province_stats(t.silver))
    assert text.count("FileScan") == 1
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["is_remote", "location_state", "salary_min", "seniority"]
    assert "partial_count" in text


def test_quantiles_do_not_gather_a_group(t):
    text = plan(quantiles.grouped_median(t.lineitem, "l_returnflag", "l_extendedprice"))
    assert "percentile" not in text
    assert re.search(r"Exchange hashpartitioning\(l_returnflag#\d+, value#\d+", text)


def test_merge_filters_the_target_by_key_only(t):
    target = t.orders.select(F.col("o_orderkey").alias("id"), "o_totalprice")
    batch = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("o_totalprice"), F.col("l_linenumber").alias("arrival"))
    assert "LeftAnti" in plan(merge.merge_upsert(target, batch, "id"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_tables(spark, name):
    if name.startswith(("stream_", "map_", "ingest_", "limit_")):
        pytest.skip("covered by the comparison with its twin")
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_quantiles_and_shares_scan_their_input_once(t):
    for df in (
        quantiles.grouped_median(t.lineitem, "l_returnflag", "l_extendedprice"),
        quantiles.box_stats(t.orders, "o_orderpriority", "o_totalprice"),
        gold.province_share(t.silver),
    ):
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        assert "ReusedExchange" in final and final.count("FileScan") <= 1


def test_a_small_batch_does_not_shuffle_the_target(t):
    batch = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    small = dedup.filter_new(batch, t.orders, "o_orderkey", rows=6000)
    assert "LeftSemi, BuildRight" in plan(small)
    assert sorted(small.collect()) == sorted(dedup.filter_new(batch, t.orders, "o_orderkey").collect())
    large = dedup.filter_new(batch, t.orders, "o_orderkey", rows=dedup.SMALL_BATCH + 1)
    assert "LeftSemi" not in plan(large)


def test_the_wide_view_joins_a_stored_company_table_and_stores_no_silver(spark, tmp_path):
    folder = shutil.copytree(FOLDER, tmp_path / "own").as_posix()
    rows = QUERIES["jobs_enriched"](spark, folder)
    assert {name for _, at, name in tables._STORED if at == folder} == {"companies"}
    text = plan(rows)
    # The companies are made before; nothing of the postings is dealt out by their domain.
    assert "HashAggregate" not in text and "_probe" not in "".join(re.findall(r"Exchange hashpartitioning[^\n]*", text))


def test_stored_rows_that_are_made_again_are_stored_without_derived_columns(spark, tmp_path):
    folder = shutil.copytree(FOLDER, tmp_path / "own").as_posix()
    QUERIES["backfill_silver"](spark, folder)
    stored = next(path for (_, at, _), path in tables._STORED.items() if at == folder)
    assert not {"skills_tags", "seniority", "years_experience_min"} & set(spark.read.parquet(stored).columns)
