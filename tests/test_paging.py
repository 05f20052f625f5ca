"""Crawls end where the paging rules say, in the data source, as a stream, and over tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sluicework.sources import paging


def land(root, crawl, pages, first=1):
    """Pages as envelopes: (number of records, total, token); None leaves a page out."""
    for place, page in enumerate(pages):
        if page is None:
            continue
        size, total, token = page
        folder = root / f"crawl={crawl}" / f"page={first + place}"
        folder.mkdir(parents=True, exist_ok=True)
        envelope = {"data": [{"id": f"{crawl}-{place}-{i}"} for i in range(size)], "total": total, "next": {"token": token}}
        (folder / "part-0.json").write_text(json.dumps({k: v for k, v in envelope.items() if v is not None}) + "\n")
        (folder / "_SUCCESS").write_text("")


CRAWLS = {
    "a": [(2, 5, "t"), (2, 5, "t"), (1, 5, None), (3, 5, "t")],
    "b": [(2, 99, "t"), (0, 99, "t"), (2, 99, "t")],
    "c": [(2, None, None), (2, None, "t")],
    "d": [(1, 9, "t"), None, (1, 9, "t")],
    "e": [(0, 0, None)],
}
PAGES = {
    "empty": {"a": [0, 1, 2, 3], "b": [0], "c": [0, 1], "d": [0], "e": []},
    "total": {"a": [0, 1, 2], "b": [0], "c": [0], "d": [0], "e": []},
    "token": {"a": [0, 1, 2], "b": [0], "c": [0], "d": [0], "e": []},
}


@pytest.fixture
def landing(tmp_path):
    for crawl, pages in CRAWLS.items():
        land(tmp_path, crawl, pages, first=0 if crawl == "c" else 1)
    return str(tmp_path)


def taken(rows):
    found = {crawl: [] for crawl in CRAWLS}
    for r in rows:
        found[r.crawl].append(r.page - (r.crawl != "c"))
    return {crawl: sorted(pages) for crawl, pages in found.items()}


@pytest.mark.parametrize("stop", paging.RULES)
@pytest.mark.parametrize("limit", [None, 1, 2])
def test_rules(spark, landing, stop, limit):
    expected = {c: [p for p in pages if limit is None or p < limit] for c, pages in PAGES[stop].items()}
    source = paging.read_crawls(spark, landing, "data", stop, limit, token="next.token")
    assert taken(source.collect()) == expected
    rows = spark.read.text(landing).withColumn("size", F.expr("json_array_length(get_json_object(value, '$.data'))"))
    total, token = F.get_json_object("value", "$.total").cast("int"), F.get_json_object("value", "$.next.token")
    assert taken(paging.stop_pages(rows, F.col("size"), stop, limit, total, token).collect()) == expected


def test_pages_behind_the_end_are_not_opened(landing, monkeypatch):
    opened = []
    rules = paging._Rules({"path": landing, "stop": "total"})
    read = rules._lines
    monkeypatch.setattr(rules, "_lines", lambda files: opened.extend(files) or read(files))
    pages = dict(rules.listed())
    assert [page for page, _ in rules.taken(pages["a"])] == [1, 2, 3] and len(opened) == 3
    assert [page for page, _ in rules.taken(pages["b"])] == [1] and len(opened) == 5


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    landing, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        rows = paging.stream_crawls(spark, str(landing), "data", "token", token="next.token")
        rows.writeStream.format("parquet").option("checkpointLocation", mark).trigger(availableNow=True).start(out).awaitTermination()
        return sorted((r.crawl, r.page) for r in spark.read.parquet(out).collect())

    land(landing, "x", [(2, 9, "t"), (2, 9, "t")])
    land(landing, "y", [(2, 9, "t"), (2, 9, None)])
    first = [("x", 1), ("x", 2), ("y", 1), ("y", 2)]
    assert run() == first
    land(landing, "x", [(1, 9, "t"), (1, 9, None)], first=3)
    land(landing, "y", [(2, 9, "t")], first=3)
    assert run() == sorted([*first, ("x", 3), ("x", 4)])
    assert run() == sorted([*first, ("x", 3), ("x", 4)])


def test_odd_envelopes(spark, tmp_path):
    land(tmp_path, "a", [(1, 9, "t"), (1, 9, "t")])
    (tmp_path / "crawl=a" / "page=1" / "part-1.json").write_text('not json\n\n[1]\n{"data": "text", "total": "many"}\n')
    got = paging.read_crawls(spark, str(tmp_path), "data", "total").collect()
    assert len(got) == 5 and [r.value for r in got if r.value.startswith("not")] == ["not json"]
    assert paging.read_crawls(spark, str(tmp_path / "crawl=a"), "data").count() == 0
    with pytest.raises(Exception, match="stop must be one of"):
        paging.read_crawls(spark, str(tmp_path), "data", "never").collect()


def test_long_lines_go_on_in_small_batches_and_large_crawls_are_dealt_out(tmp_path, monkeypatch):
    for crawl in ("a", "b", "c"):
        for page in (1, 2):
            (tmp_path / f"crawl={crawl}" / f"page={page}").mkdir(parents=True)
            (tmp_path / f"crawl={crawl}" / f"page={page}" / "part").write_text(json.dumps({"data": ["x" * 100]}) + "\n")
    rules = paging._Rules({"path": str(tmp_path)})
    monkeypatch.setattr(paging, "TASK_BYTES", 300)
    monkeypatch.setattr(paging, "BATCH_BYTES", 100)
    parts = paging._dealt(rules, -1, paging.LAST_PAGE)
    assert [[crawl for crawl, _ in part.crawls] for part in parts] == [["a"], ["b"], ["c"]]
    batches = [b for part in parts for b in paging._read(rules, part)]
    assert [b.num_rows for b in batches] == [1] * 6 and [b["crawl"][0].as_py() for b in batches] == list("aabbcc")
