"""Tables derived for the registered queries: only what a query reads is computed, and large texts are not sorted."""

from __future__ import annotations

import pytest

from tests.test_plans import plan
from workload import tables
from workload.q_stream import _feeds
from workload.tables import Tables


@pytest.fixture
def small(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.sql("SELECT id AS n_nationkey, 'NATION ' || id AS n_name, id % 2 AS n_regionkey FROM range(3)").write.parquet(f"{folder}/nation.parquet")
    spark.sql("SELECT id AS r_regionkey, 'REGION ' || id AS r_name FROM range(2)").write.parquet(f"{folder}/region.parquet")
    spark.sql("SELECT id AS s_suppkey, 'S' || id AS s_name, id % 3 AS s_nationkey FROM range(4)").write.parquet(f"{folder}/supplier.parquet")
    spark.sql("SELECT id AS c_custkey, 'MACHINERY' AS c_mktsegment, id % 3 AS c_nationkey FROM range(10)").write.parquet(f"{folder}/customer.parquet")
    orders = "SELECT id AS o_orderkey, id % 10 AS o_custkey, 1000.5 + id AS o_totalprice, timestamp'1994-03-01' + make_interval(id % 4) AS o_orderdate FROM range(400)"
    for name in {*tables.NAMES} - {"nation", "region", "supplier", "customer", "orders"}:
        spark.range(1).write.parquet(f"{folder}/{name}.parquet")
    spark.sql(orders).write.parquet(f"{folder}/orders.parquet")
    return Tables(spark, folder)


def test_only_the_columns_that_are_read_are_made_and_stored(small):
    narrow = small.silver_of("title", "salary_min", "job_id")
    path = tables._STORED[small.spark.sparkContext.applicationId, small.folder, "silver.job_id.salary_min.title"]
    assert small.spark.read.parquet(path).columns == ["job_id", "salary_min", "title"]
    assert small.silver_of("title").inputFiles() == narrow.select("title").inputFiles()
    whole = small.silver.select("job_id", "salary_min", "title")
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.collect())) and narrow.count() == 400


def test_stored_silver_is_read_where_it_is_whole(small):
    files = set(small.silver.inputFiles())
    assert set(small.silver_of("seniority").inputFiles()) == files


def test_many_columns_have_a_short_path(small):
    from sluicework import schemas

    assert small.silver_of("job_id", *schemas.FIELDS, *schemas.RAW_FIELDS).count() == 400


def test_landed_pages_are_written_without_a_sort(small, monkeypatch):
    settings = []
    monkeypatch.setattr(Tables, "silver", None)
    path = small.stored("landing_feeds", lambda: settings.append(small.spark.conf.get(tables._WRITERS)) or _feeds(small).repartition(8, "feed", "page"), "text", "feed", "page")
    rows = small.spark.read.text(path)
    assert settings == ["256"] and small.spark.conf.get(tables._WRITERS) == "0"
    assert len(rows.inputFiles()) == rows.select("feed", "page").distinct().count() and rows.count() == 400 + 3 + 2 + 4
    assert "Sort" not in plan(rows)
