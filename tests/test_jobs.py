"""Landed files to stored tables, backfill, streams."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluicework import schemas
from sluicework.operators import merge
from sluicework.plans import gold, ingest, parts
from sluicework.plans.silver import to_silver
from sluicework.sources import mappings, readers
from sluicework.streaming import jobs

def stamp():
    return F.lit("2026-03-10 12:00:00").cast("timestamp")


def jsearch(i, **more):
    return {
        "job_id": f"j{i}", "job_title": "Senior Cloud Engineer", "employer_name": "Birkenhof Labs",
        "employer_website": "https://www.birkenhof.example", "job_city": "Montréal", "job_state": None, "job_country": "CA",
        "job_is_remote": False, "job_employment_type": "FULL_TIME", "job_min_salary": 100000, "job_max_salary": 150000,
        "job_salary_period": "YEAR", "job_description": "<p>You know python and sql.</p>",
        "job_apply_link": "https://jobs.birkenhof.example/apply", "job_posted_at_datetime_utc": "2026-03-01T10:00:00Z", **more,
    }


def adzuna(i, **more):
    return {
        "id": str(i), "title": "Cloud Engineer", "company": {"display_name": "Birkenhof Labs"},
        "location": {"area": ["Canada", "Ontario", "Toronto"], "display_name": "Toronto"},
        "description": "This is a remote role.", "redirect_url": "https://a.example/1", "salary_min": 90000.0,
        "salary_max": 130000.0, "contract_time": "full_time", "created": "2026-03-01T10:00:00Z", **more,
    }


def theirstack(i, **more):
    return {
        "id": f"t{i}", "job_title": "Cloud Engineer", "company_name": "Beta", "company_url": "beta.io",
        "city": "Toronto", "state": "ON", "country": "Canada", "remote": False, "employment_type": "contract",
        "salary_min": 95000, "salary_max": 135000, "description": "At least 2 years.", "url": "https://b.example/1",
        "date_posted": "2026-03-01", **more,
    }


def serpapi(i, **more):
    return {
        "job_id": f"s{i}", "title": "Cloud Engineer", "company_name": "Gamma", "location": "Toronto, ON, Canada",
        "description": "python", "thumbnail": "https://g.example/l.png",
        "apply_options": [{"link": "https://g.example/apply", "title": "Apply"}],
        "detected_extensions": {
            "schedule_type": "Full-time", "work_from_home": False, "posted_at": "3 days ago",
            "salary": "$45–$55 an hour",
        }, **more,
    }


ENVELOPES = {"jsearch": "data", "adzuna": "results", "theirstack": "data", "serpapi": "jobs_results"}


def land(root, source, page, items, name="part"):
    folder = root / source / f"page={page}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps({ENVELOPES[source]: items}) + "\n")


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    land(root, "jsearch", 1, [jsearch(1), jsearch(2, employer_website=""), jsearch(1, job_title="Copy")])
    land(root, "jsearch", 2, [])
    land(root, "adzuna", 1, [adzuna(i) for i in range(10)])
    land(root, "adzuna", 2, [adzuna(i, location={"area": []}) for i in range(10, 15)])
    land(root, "theirstack", 1, [theirstack(1), {"job_title": "no id"}])
    land(root, "serpapi", 1, [serpapi(1), serpapi(2, apply_options=[], detected_extensions=None, location="Canada")])
    return {s: str(root / s) for s in ENVELOPES}


def test_mapping_and_arrival(spark, landing):
    rows = {r.job_id: r for r in readers.ingest_bronze(spark, landing, stamp()).filter("title_raw <> 'Copy'").collect()}
    assert len(rows) == 2 + 15 + 1 + 2
    assert rows["j1"].company_domain_raw == "https://www.birkenhof.example"
    assert rows["j2"].company_domain_raw == "https://jobs.birkenhof.example/apply"
    a = rows["adzuna_3"]
    assert (a.location_city_raw, a.location_state_raw, a.location_country_raw) == ("Toronto", "Ontario", "Canada")
    assert (a.salary_currency_raw, a.salary_period_raw, a.company_domain_raw, a.is_remote_raw) == ("CAD", "YEAR", None, None)
    assert rows["adzuna_12"].location_state_raw is None and rows["adzuna_12"].location_country_raw == "Canada"
    assert rows["theirstack_t1"].salary_currency_raw is None
    s = rows["serpapi_s1"]
    assert (s.salary_min_raw, s.salary_max_raw, s.salary_period_raw) == (45.0, 55.0, "HOUR")
    assert s.job_apply_link_raw == "https://g.example/apply" and s.posted_at_raw == "3 days ago"
    s = rows["serpapi_s2"]
    assert (s.job_apply_link_raw, s.salary_min_raw, s.location_city_raw) == (None, None, None)
    assert s.location_country_raw == "Canada"


def test_pages_are_limited_and_bad_sources_skipped(spark, landing):
    rows = readers.ingest_bronze(spark, {**landing, "jsearch": "/nowhere/at/all"}, stamp(), max_pages=1)
    counts = {r.source: r["count"] for r in rows.groupBy("source").count().collect()}
    assert counts == {"adzuna": 10, "theirstack": 1, "serpapi": 2}
    with pytest.raises(ValueError):
        readers.ingest_bronze(spark, {"jsearch": "/nowhere/at/all"}, stamp())


def test_period_from_text_can_be_turned_off(spark, landing):
    source = mappings.sources()["serpapi"]
    pages = readers.read_pages(spark, landing["serpapi"], source)
    assert mappings.map_serpapi(pages, period_from_text=False).filter("salary_period_raw is not null").count() == 0


def test_a_new_source_is_one_registration(spark, tmp_path):
    def mapping(pages):
        renamed = {f"{f}_raw": F.lit(None).cast(schemas.RAW_TYPES.get(f"{f}_raw", "string")) for f in schemas.FIELDS}
        return pages.select(F.concat(F.lit("own_"), "id").alias("job_id"), F.lit(0).alias("pos")).withColumns(renamed)

    mappings.register_source("own", "id string", mapping)
    try:
        (tmp_path / "own.json").write_text('{"id": "7"}\n')
        rows = readers.ingest_bronze(spark, {"own": str(tmp_path / "own.json")}, stamp())
        assert [r.job_id for r in rows.collect()] == ["own_7"]
    finally:
        mappings._REGISTRY.pop("own")


def test_ingest_inserts_only_new_keys(spark, landing, tmp_path):
    store = ingest.Store(str(tmp_path / "store"))
    curated = spark.createDataFrame([("serpapi_s2", 77000.0)], "job_id string, salary_min double")
    first = ingest.run_ingest(spark, landing, store, curated, stamp())
    land(tmp_path / "landing", "theirstack", 2, [theirstack(1, job_title="Changed"), theirstack(9)])
    second = ingest.run_ingest(spark, landing, store, curated, stamp())
    rows = {r.job_id: r for r in store.postings(spark).collect()}
    assert len(rows) == store.postings(spark).count() == 21
    assert rows["j1"].title == "Senior Cloud Engineer" and rows["theirstack_t1"].title == "Cloud Engineer"
    assert rows["j1"].location_city == "Montreal" and rows["j1"].location_state == "Quebec"
    assert rows["j1"].skills_tags == ["python", "sql"] and rows["j1"].seniority == "Senior"
    assert rows["j1"].company_domain == "birkenhof.example" and rows["adzuna_3"].is_remote
    assert rows["serpapi_s1"].salary_min == 93600.0 and rows["serpapi_s1"].salary_period == "YEAR"
    assert rows["serpapi_s1"].posted_at == datetime(2026, 3, 7, 13)  # across the change to summer time
    assert rows["serpapi_s2"].salary_min == 77000.0 and rows["serpapi_s2"].filled
    runs = {r.run_id: r for r in merge.current_runs(store.run_events(spark)).collect()}
    a, b = runs[first], runs[second]
    assert (a.status, a.jobs_fetched, a.jobs_new, a.jobs_duplicate, a.jobs_skipped) == ("success", 21, 20, 1, 0)
    assert (b.status, b.jobs_fetched, b.jobs_new, b.jobs_duplicate, b.jobs_skipped) == ("success", 23, 1, 0, 22)
    domains = [r.domain for r in store.companies(spark).collect()]
    assert sorted(domains) == ["beta.io", "birkenhof.example", "jobs.birkenhof.example"]


def test_a_repeated_run_replaces_its_own_output(spark, landing, tmp_path):
    store = ingest.Store(str(tmp_path / "store"))
    for _ in range(2):
        ingest.run_ingest(spark, landing, store, fetched_at=stamp(), run="r1")
    assert store.postings(spark).count() == 20 and store.companies(spark).count() == 3


def test_a_failed_run_is_logged(spark, tmp_path):
    store = ingest.Store(str(tmp_path / "store"))
    with pytest.raises(ValueError):
        ingest.run_ingest(spark, {"adzuna": "/nowhere/at/all"}, store)
    row = merge.current_runs(store.run_events(spark)).first()
    assert row.status == "failed" and "no source" in row.error_message


def test_backfill_gives_the_same_silver(spark, landing, tmp_path):
    store, other = ingest.Store(str(tmp_path / "a")), ingest.Store(str(tmp_path / "b"))
    ingest.run_ingest(spark, landing, store, fetched_at=stamp())
    ingest.backfill(spark, store, other)
    kept = ["job_id", *schemas.FIELDS, *schemas.DERIVED_FIELDS]
    a, b = store.postings(spark).select(kept), other.postings(spark).select(kept)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_silver_is_repeatable_and_tags_sorted(spark, landing):
    bronze = readers.ingest_bronze(spark, landing, stamp())
    one, two = to_silver(bronze), to_silver(bronze)
    assert one.exceptAll(two).count() == 0
    unsorted = ~F.col("skills_tags").eqNullSafe(F.array_sort(F.array_distinct("skills_tags")))
    assert one.filter(unsorted).count() == 0


def test_a_new_checkpoint_overwrites_nothing(spark, tmp_path):
    source, store = mappings.sources()["theirstack"], ingest.Store(str(tmp_path / "store"))
    for k in (1, 2):
        land(tmp_path / f"landing{k}", "theirstack", 1, [theirstack(k)])
        jobs.ingest_stream(
            spark, source, str(tmp_path / f"landing{k}/theirstack"), store, str(tmp_path / f"checkpoint{k}"), stamp()
        ).awaitTermination()
    assert sorted(r.job_id for r in store.postings(spark).collect()) == ["theirstack_t1", "theirstack_t2"]


def test_rejects_are_kept_and_counted(spark, tmp_path):
    root, store = tmp_path / "landing", ingest.Store(str(tmp_path / "store"))
    land(root, "theirstack", 1, [theirstack(1), {"job_title": "no id"}])
    with open(root / "theirstack/page=1/part.json", "a") as file:
        file.write('{"data": [{"id": "cut\n{"error": "limit"}\n\n')
    land(root, "jsearch", 1, [jsearch(1)])
    (root / "jsearch/page=1/bad.json.gz").write_bytes(b"this is no archive")
    ingest.run_ingest(spark, {"theirstack": str(root / "theirstack"), "jsearch": str(root / "jsearch")}, store, fetched_at=stamp())
    found = sorted((r.reason, r.records) for r in store.rejects(spark).collect())
    assert found == [("broken line", 1), ("no id", 1), ("no records", 1)]
    assert [r.job_id for r in store.postings(spark).collect()] == ["theirstack_t1"]
    done = store.run_events(spark).filter("status = 'success'").first()
    assert (done.jobs_fetched, done.jobs_rejected) == (1, 3)


def test_a_long_error_is_logged_whole(spark, tmp_path):
    store = ingest.Store(str(tmp_path / "store"))
    with pytest.raises(ValueError):
        ingest.run_ingest(spark, {}, store)
    ingest.log_run(spark, store, "r", "failed", error_message="x" * 5000)
    assert store.run_events(spark).filter("run_id = 'r'").first().error_message == "x" * 5000


def test_stream_ingest_takes_new_files_only(spark, tmp_path):
    root, source = tmp_path / "landing", mappings.sources()["theirstack"]
    store = ingest.Store(str(tmp_path / "store"))

    def run():
        query = jobs.ingest_stream(
            spark, source, str(root / "theirstack"), store, str(tmp_path / "checkpoint"), stamp(), max_files=1
        )
        query.awaitTermination()

    land(root, "theirstack", 1, [theirstack(1), theirstack(2), theirstack(2)])
    run()
    assert store.postings(spark).count() == 2
    land(root, "theirstack", 2, [theirstack(2, job_title="Changed"), theirstack(3)])
    run()
    rows = {r.job_id: r.title for r in store.postings(spark).collect()}
    assert len(rows) == store.postings(spark).count() == 3 and rows["theirstack_t2"] == "Cloud Engineer"


def test_streams_with_state(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "job_id string, posted_at timestamp, remote boolean"

    def put(name, rows):
        lines = [json.dumps(dict(zip(("job_id", "posted_at", "remote"), r))) + "\n" for r in rows]
        (folder / name).write_text("".join(lines))
        os.utime(folder / name, (1.7e9 + int(name[0]) * 60,) * 2)

    # Files are taken in the order of their times.
    put("1.json", [("a", "2024-01-01 10:00:00", True), ("a", "2024-01-02 10:00:00", False), ("b", "2024-01-07 23:59:59", False)])
    put("2.json", [("a", "2024-01-03 10:00:00", True), ("c", "2024-01-08 00:00:00", True)])
    put("3.json", [("d", "2024-03-01 00:00:00", True)])

    def run(build, out):
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
        writer = build(rows).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{out}-c"))
        writer.trigger(availableNow=True).start(str(tmp_path / out)).awaitTermination()
        return spark.read.parquet(str(tmp_path / out)).collect()

    spread = F.pmod(F.hash("posted_at"), F.lit(4))
    for out, salt in (("plain", None), ("spread", spread)):
        unique = run(lambda r, s=salt: jobs.drop_repeats(r, "job_id", spread=s), out)
        assert sorted(r.job_id for r in unique) == ["a", "b", "c", "d"]
    weeks = run(lambda r: jobs.weekly_stream(r, "posted_at", F.col("remote")), "weeks")
    assert {(str(r.week_start), r.job_count, r.remote_count) for r in weeks} == {("2024-01-01", 4, 2), ("2024-01-08", 1, 1)}


def test_the_latest_state_of_each_posting(spark, landing, tmp_path):
    store = ingest.Store(str(tmp_path / "store"))
    ingest.run_ingest(spark, landing, store, fetched_at=stamp(), run="one")
    assert ingest.refresh_latest(spark, store, "one", parts=8)
    land(tmp_path / "landing", "theirstack", 2, [theirstack(1, job_title="Senior Changed"), theirstack(9)])
    changed = {"theirstack": f"{tmp_path}/landing/theirstack/page=2"}
    ingest.run_ingest(spark, changed, store, fetched_at=F.lit("2026-03-11 12:00:00").cast("timestamp"), run="two")
    touched = ingest.refresh_latest(spark, store, "two", parts=8)
    assert 1 <= len(touched) <= 2
    rows = {r.job_id: r for r in ingest.latest_table(store, 8).read(spark).collect()}
    assert len(rows) == 21 and {r.job_id: r.title for r in store.postings(spark).collect()}["theirstack_t1"] == "Cloud Engineer"
    now = rows["theirstack_t1"]
    assert (now.title, now.seniority, now.fetched_at) == ("Senior Changed", "Senior", datetime(2026, 3, 11, 12))
    assert now.created_at < now.updated_at and rows["j1"].title == "Senior Cloud Engineer"


def test_all_feeds_in_one_stream(spark, tmp_path):
    root = tmp_path / "landing"

    def put(feed, page, items, name="part"):
        land(root, f"feed={feed}", page, items, name)

    ENVELOPES.update({f"feed={s}": e for s, e in list(ENVELOPES.items())})
    put("jsearch", 1, [jsearch(1), jsearch(2)])
    put("adzuna", 1, [adzuna(1)])
    put("theirstack", 1, [theirstack(1), {"job_title": "no id"}])
    put("serpapi", 1, [serpapi(1)])
    (root / "feed=adzuna" / "page=1" / "bad.json").write_text('{"results": [\n')
    (root / "feed=other" / "page=1").mkdir(parents=True)
    (root / "feed=other" / "page=1" / "x.json").write_text("{}\n\n")
    store, mark = ingest.Store(str(tmp_path / "store")), str(tmp_path / "mark")
    jobs.ingest_feeds(spark, str(root), store, mark, stamp()).awaitTermination()
    put("serpapi", 2, [serpapi(1, title="Copy"), serpapi(2)])
    put("jsearch", 3, [jsearch(3)])
    jobs.ingest_feeds(spark, str(root), store, mark, stamp()).awaitTermination()
    rows = {r.job_id: r for r in store.postings(spark).collect()}
    assert sorted(rows) == ["adzuna_1", "j1", "j2", "j3", "serpapi_s1", "serpapi_s2", "theirstack_t1"]
    assert rows["serpapi_s1"].title == "Cloud Engineer" and rows["j1"].location_city == "Montreal"
    assert sorted((r.source, r.reason, r.records) for r in store.rejects(spark).collect()) == [
        ("adzuna", "broken line", 1), ("other", "unknown feed", 1), ("theirstack", "no id", 1),
    ]
    runs = merge.current_runs(store.run_events(spark)).orderBy("run_at").collect()
    assert [(r.status, r.jobs_fetched, r.jobs_new, r.jobs_skipped, r.jobs_rejected) for r in runs] == [("success", 5, 5, 0, 3), ("success", 3, 2, 1, 0)]


def test_the_first_row_of_a_key_stays_across_batches(spark, tmp_path):
    out, mark, kinds = str(tmp_path / "out"), str(tmp_path / "mark"), "k string, n int, v string"

    def arrive(name, rows):
        spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(str(tmp_path / "in" / name))
        stream = spark.readStream.schema(kinds).parquet(str(tmp_path / "in" / "*"))
        jobs.first_rows(stream, "k", "n", out, mark).awaitTermination()
        return sorted((r.k or "", r.n, r.v) for r in spark.read.parquet(f"{out}/*").collect())

    assert arrive("1", [("a", 2, "later"), ("a", 1, "first"), ("b", 5, "b")]) == [("a", 1, "first"), ("b", 5, "b")]
    got = arrive("2", [("a", 0, "too late"), ("c", 9, "c2"), ("c", 8, "c"), (None, 1, "no key")])
    assert [r for r in got if r[0]] == [("a", 1, "first"), ("b", 5, "b"), ("c", 8, "c")]
    assert [r for r in arrive("3", [("b", 1, "x"), ("d", 1, "d")]) if r[0]] == [("a", 1, "first"), ("b", 5, "b"), ("c", 8, "c"), ("d", 1, "d")]


def test_gold_from_parts_equals_gold(spark, landing, tmp_path):
    store = ingest.Store(str(tmp_path / "store"))
    assert parts.province_stats(spark, store).count() == 0 and parts.overview_kpis(spark, store).first().total_jobs == 0
    for run, pages in (("one", 1), ("two", None), ("two", None)):
        ingest.run_ingest(spark, landing, store, fetched_at=stamp(), max_pages=pages, run=run)
        parts.add_run(spark, store, run)
        whole = store.postings(spark)
        for made, part in (
            (gold.province_stats(whole), parts.province_stats(spark, store)),
            (gold.weekly_trends(whole), parts.weekly_trends(spark, store)),
            (gold.overview_kpis(whole), parts.overview_kpis(spark, store)),
        ):
            assert made.columns == part.columns and sorted(made.collect()) == sorted(part.collect())


def test_a_line_is_parsed_once_for_its_records_and_once_for_each_kind_of_reject(spark):
    lines = spark.createDataFrame([(1, '{"data": [{"id": "1"}, {"job_title": "x"}]}'), (1, '{"data": [{"id"'), (2, "{}")], "page int, value string")
    source = mappings.sources()["theirstack"]

    def parses(rows):
        return rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(")

    rows, left = source.mapping(readers.pages_of(lines, source)), readers.rejects_of(lines, source)
    assert [r.job_id for r in rows.collect()] == ["theirstack_1"]
    assert sorted((r.page, r.reason, r.records) for r in left.collect()) == [(1, "broken line", 1), (1, "no id", 1), (2, "no records", 1)]
    assert (parses(rows), parses(left)) == (1, 3)
