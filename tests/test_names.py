"""Names of a table in texts: equal to the scans with constants, and indifferent to how many names there are."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from sluicework import lookups
from sluicework.functions import text as X
from sluicework.operators import names
from tests.test_plans import plan
from tests.test_text import _tags_by_definition


def terms_of(spark, terms):
    return spark.createDataFrame(list(enumerate(terms)), "order int, term string")


def cities_of(spark, more=()):
    listed = [*lookups.CITY_PROVINCES.items(), *more]
    return spark.createDataFrame([(c, lookups.city_display(c), p, i) for i, (c, p) in enumerate(listed)], "name string, city string, province string, order int")


def texts_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


TAXONOMIES = [
    lookups.TAXONOMY,
    ["spark", "spark streaming", "streaming media", "media"],
    ["a b", "b c", "c", "a b c", "c a"],
    ["sql", "no sql", ".net", "c++", "++", "SQL Server", "sql"],
    ["a", "a-b", "a-b-c", "b-c x", "é", "x é"],
]


@pytest.mark.parametrize("taxonomy", TAXONOMIES)
def test_terms_equal_one_alternation(spark, taxonomy):
    rng = random.Random(5)
    pieces = [*taxonomy, *(t.upper() for t in taxonomy), "the", "-", "/", ",", "é", "x", "sqlite", "a", "b", "c", "++", "."]
    texts = [rng.choice(["", " ", "  "]).join(rng.choices(pieces, k=12)) for _ in range(200)]
    texts += [" ".join(rng.choices(pieces, k=12)) for _ in range(200)]
    got = {r.id: r.tags for r in names.extract_terms(texts_of(spark, [*texts, "", None]), terms_of(spark, taxonomy), "id", "text").collect()}
    assert got == {i: _tags_by_definition(t or "", taxonomy) for i, t in enumerate([*texts, "", None])}


def test_fifty_thousand_terms(spark):
    terms = [f"term{i}" if i % 3 else f"term{i} of part {i % 7}" for i in range(50_000)]
    texts = [f"has term{i}, and Term{i + 1} of part {(i + 1) % 7}! term{i + 2} or" for i in range(0, 49_000, 997)]
    found = names.extract_terms(texts_of(spark, texts), terms_of(spark, terms), "id", "text")
    few = names.extract_terms(texts_of(spark, texts), terms_of(spark, terms[:6]), "id", "text")
    assert len(plan(found)) == pytest.approx(len(plan(few)), rel=0.02)
    known = set(terms)
    expected = {}
    for i, t in enumerate(texts):
        words = re.findall(r"term\d+ of part \d|term\d+", t.lower())
        expected[i] = sorted({w if w in known else w.split()[0] for w in words} & known)
    assert {r.id: r.tags for r in found.collect()} == expected and sum(map(len, expected.values())) > 90


PLACES = [
    "Office in Toronto, ON.", "based in montreal quebec", "London on the river", "move to Halifax, BC", "Richmond Hill, Ontario or Richmond, BC",
    "Montreal, Quebec City, QC", "St. John's NL", "Fort McMurray Alberta", "NewToronto ON", "somewhere , AB and more", "somewhere, ab",
    "Montréal, QC", "Edmonton Edmonton, AB", "torontoon", "Toronto ,ON", "Toronto,, ON", "Toronto ONE", "Calgary Ontario, then Laval, Quebec", "Red Deer,Alberta",
    "station ON, solutions NS", "", None,
]


def test_places_equal_the_scan_with_constants(spark):
    rng = random.Random(3)
    parts = [*lookups.CITY_PROVINCES, "ON", "bc", "Ontario", "Quebec", "Yukon", ",", " ", "x", "on the", "solutions", "British Columbia"]
    texts = PLACES + ["".join(rng.choices([*parts, " ", ", "], k=9)) for _ in range(400)]
    texts = [t if t is None else re.sub(r"\s+", " ", t).strip() for t in texts]
    rows = texts_of(spark, texts)
    scanned = rows.select("id", X.infer_location_from_text(F.col("text")).alias("f")).select("id", "f.city", "f.province")
    got, expected = ({r.id: (r.city, r.province) for r in x.collect()} for x in (names.locate(rows, cities_of(spark), "id", "text"), scanned))
    assert got == expected and len({p for _, p in got.values()}) > 8


def test_ten_thousand_cities(spark):
    more = [(f"new city {i}", "Ontario" if i % 2 else "Quebec") for i in range(10_000)]
    rows = texts_of(spark, ["we are in New City 77, Ontario", "or new city 78 quebec", "new city 79, Quebec", "Toronto, ON"])
    found = names.locate(rows, cities_of(spark, more), "id", "text")
    few = names.locate(rows, cities_of(spark, more[:3]), "id", "text")
    assert len(plan(found)) < 1.1 * len(plan(few))
    assert [(r.city, r.province) for r in found.orderBy("id").collect()] == [
        (lookups.city_display("new city 77"), "Ontario"), (lookups.city_display("new city 78"), "Quebec"), (None, None), ("Toronto", "Ontario"),
    ]


def test_no_names(spark):
    rows = texts_of(spark, ["Toronto, ON", None])
    assert [r.tags for r in names.extract_terms(rows, terms_of(spark, ["x"]).filter("false"), "id", "text").collect()] == [[], []]
    assert [(r.city, r.province) for r in names.locate(rows, cities_of(spark).filter("false"), "id", "text").orderBy("id").collect()] == [(None, "Ontario"), (None, None)]


def _stored_texts(spark, tmp_path):
    path = str(tmp_path / "texts")
    texts_of(spark, PLACES).write.parquet(path)
    return spark.read.parquet(path)


def test_names_are_sent_to_the_tasks_and_never_the_texts(spark, tmp_path, monkeypatch):
    rows = _stored_texts(spark, tmp_path)
    terms, cities = terms_of(spark, lookups.TAXONOMY), cities_of(spark)
    for found in (names.locate(rows, cities, "id", "text"), names.extract_terms(rows, terms, "id", "text")):
        assert "Inner, BuildRight" in plan(found) and "Inner, BuildLeft" not in plan(found)
    few = names.locate(rows, cities, "id", "text").collect()
    monkeypatch.setattr(names, "SMALL_NAMES", 2)
    many = names.locate(rows, cities, "id", "text")
    assert re.search(r"SortMergeJoin \[name#\d+\], \[name#\d+\], Inner", plan(many)) and sorted(map(str, many.collect())) == sorted(map(str, few))


def test_a_piece_does_not_carry_its_whole_text(spark):
    found = names.extract_terms(texts_of(spark, ["a b a c"]), terms_of(spark, ["a b", "a"]), "id", "text")
    kept = re.findall(r"posexplode\(.*\), \[([^\]]*)\], (?:true|false), \[at", plan(found))
    assert kept and not any("_pieces" in k for k in kept)
    assert [r.tags for r in found.collect()] == [["a", "a b"]]
