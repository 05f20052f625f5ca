from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluicework.operators import dedup, joins, merge, quality
from sluicework.operators.keyed import KeyedTable

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 2, 1)


@pytest.mark.parametrize(
    ("incoming", "existing", "new", "skipped"),
    [("ab", "", "ab", 0), ("ab", "ab", "", 2), ("abc", "b", "ac", 1), ("", "", "", 0), ("aab", "b", "aa", 1)],
)
def test_filter_new(spark, incoming, existing, new, skipped):
    left = spark.createDataFrame([(k,) for k in incoming], "job_id string")
    right = spark.createDataFrame([(k,) for k in existing], "job_id string")
    assert sorted(r[0] for r in dedup.filter_new(left, right, "job_id").collect()) == sorted(new)
    assert dedup.known_rows(left, right, "job_id").count() == skipped
    counts = dedup.dedup_counts(left, right, "job_id").first()
    assert (counts.incoming, counts.skipped) == (len(incoming), skipped)
    assert (counts.new, counts.duplicate) == (len(set(new)), len(new) - len(set(new)))


def test_one_row_per_key(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None), ("b", None, "z")], "k string, t int, v string")
    first = {r.k: r.v for r in dedup.first_per_key(rows, "k", "t").collect()}
    last = {r.k: r.v for r in dedup.last_per_key(rows, "k", "t").collect()}
    assert first == {"a": "y", "b": None} and last == {"a": "x", "b": None}


def test_ties_are_settled_the_same_way_each_time(spark):
    rows = spark.range(2000).select((F.col("id") % 7).alias("k"), F.lit(1).alias("t"), "id")
    a = dedup.first_per_key(rows, "k", "t").orderBy("k").collect()
    b = dedup.first_per_key(rows.repartition(5), "k", "t").orderBy("k").collect()
    assert a == b


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [("a", "old a", 1, OLD, OLD), ("b", "old b", 2, OLD, OLD)],
        "id string, title string, extra int, created_at timestamp, updated_at timestamp",
    )


@pytest.fixture
def incoming(spark):
    return spark.createDataFrame([("b", "new b", 1), ("b", "later b", 2), ("c", "new c", 3)], "id string, title string, arrival int")


def test_merge_upsert(target, incoming):
    now = F.lit(NEW)
    got = {r.id: tuple(r)[1:] for r in merge.merge_upsert(target, incoming, "id", now=now).collect()}
    assert got == {
        "a": ("old a", 1, OLD, OLD),
        "b": ("new b", 2, OLD, NEW),
        "c": ("new c", None, NEW, NEW),
    }


def test_merging_twice_equals_merging_once(target, incoming):
    now = F.lit(NEW)
    once = merge.merge_upsert(target, incoming, "id", now=now)
    twice = merge.merge_upsert(once, incoming, "id", now=now)
    assert sorted(once.collect()) == sorted(twice.collect()) or set(once.collect()) == set(twice.collect())


def test_ensure_stubs(spark):
    companies = spark.createDataFrame([("x.io", "X", "tech")], "domain string, name string, industry string")
    rows = spark.createDataFrame(
        [("x.io", "other", 1), ("y.io", "Y1", 1), ("y.io", None, 2), ("z.io", None, 1), ("z.io", "Z", 2), ("", "e", 1), (None, "n", 1)],
        "company_domain string, company_name string, arrival int",
    )
    got = {r.domain: (r.name, r.industry) for r in merge.ensure_stubs(companies, rows).collect()}
    assert got == {"x.io": ("X", "tech"), "y.io": (None, None), "z.io": ("Z", None)}


def test_fill_from(spark):
    base = spark.createDataFrame([("a", None, 1), ("b", "x", None), ("c", None, None)], "id string, t string, n int")
    curated = spark.createDataFrame([("a", "T", 9), ("b", "U", None)], "id string, t string, n int")
    got = {r.id: (r.t, r.n, r.filled) for r in joins.fill_from(base, curated, "id", ["t", "n"]).collect()}
    assert got == {"a": ("T", 1, True), "b": ("x", None, False), "c": (None, None, False)}


def test_left_join_keeps_rows_without_key(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 10, F.lit("x")).alias("k"), "id")
    right = spark.createDataFrame([("x", 1), ("y", 2)], "d string, v int")
    joined = joins.left_join_spread_nulls(left, right, "k", "d", "id")
    assert joined.columns == ["k", "id", "v"]
    assert joined.count() == 1000 and joined.filter("v = 1").count() == 10
    assert joined.filter("k is null and v is null").count() == 990


def test_constraints(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), (None, None), ("b", "z")], "id string, d string")
    parents = spark.createDataFrame([("x",)], "domain string")
    assert {tuple(r) for r in quality.key_violations(rows, "id").collect()} == {("a", 2), (None, 1)}
    assert sorted(r.d for r in quality.orphans(rows, parents, "d", "domain").collect()) == ["y", "z"]
    cleared = quality.clear_orphans(rows, parents, "d", "domain").collect()
    assert sorted(str(r.d) for r in cleared) == ["None", "None", "None", "x"]


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_a_stored_table_rewrites_only_what_a_batch_touches(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "id long, title string, created_at timestamp, updated_at timestamp", "id", parts=16)
    assert table.read(spark).count() == 0
    first = spark.range(500).select("id", F.concat(F.lit("old "), "id").alias("title"), F.col("id").alias("arrival"))
    assert table.merge(first, now=F.lit(OLD)) == list(range(16))
    before = files_of(tmp_path / "t")
    batch = spark.createDataFrame([(7, "new 7", 1), (7, "later 7", 2), (1000, "new 1000", 1), (None, "nameless", 1)], "id long, title string, arrival int")
    touched = table.merge(batch, now=F.lit(NEW))
    assert 1 <= len(touched) <= 3
    after = files_of(tmp_path / "t")
    same = {f for f in before if f in after and before[f] == after[f]}
    assert {int(f.split("=")[1].split("/")[0]) for f in before if f not in same} == set(touched)
    got = {r.id: (r.title, r.created_at, r.updated_at) for r in table.read(spark).collect()}
    assert len(got) == 502 and got[7] == ("new 7", OLD, NEW) and got[1000] == ("new 1000", NEW, NEW) and got[8] == ("old 8", OLD, OLD)
    assert got[None] == ("nameless", NEW, NEW)
    assert table.merge(batch, now=F.lit(NEW)) == touched
    again = table.read(spark).filter("id IS NOT NULL")
    assert {r.id: (r.title, r.created_at, r.updated_at) for r in again.collect()} == {i: v for i, v in got.items() if i is not None}
    assert table.merge(batch.filter("false")) == []


def test_keys_of_a_stored_table_are_found_in_their_folders(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "id string, n long", "id", parts=16)
    table.merge(spark.range(300).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("n"), F.lit(1).alias("arrival")))
    found = table.get(spark, ["k3", "k299", "none"])
    assert sorted((r.id, r.n) for r in found.collect()) == [("k299", 299), ("k3", 3)]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part_of_16" in text and "In(id" in text
    assert table.get(spark, []).count() == 0
