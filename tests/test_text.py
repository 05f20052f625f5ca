from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from sluicework import lookups
from sluicework.functions import text as X


@pytest.mark.parametrize(
    "page",
    [
        "a&#150;b &#146;x", "score<1 ok", "I <3 data", "caf&eacute ok, 5 &times 3", "x &ampcopy; y", "&check; &num;1 &colon;",
        "<script>a &amp;&amp; b</script>", '<script data-x="a>b">y</script>', "&#0;z", "&#xD800;&#x110000;&#99999999999;",
        "&notit; &amp;lt; &unknown; & &; &#; &#x; R&D", "&#x1;a&#127;b&#11;c&#65534;d", "&nbsp;&hearts;&#x1F600;&NotEqualTilde;",
        "<style>p > a &gt; b</style><p>x &lt; y</p>", "<!-- <script>&amp; -->k", "&#000000000233;&#x00000000E9;", "&copy2024 &reg;&regx",
    ],
)
def test_native_cleaning_equals_the_parser(apply, page):
    assert apply(X.clean_html, [page]) == apply(lambda c: X.clean_html(c, exact=True), [page])


def test_clean_html(apply):
    cases = {
        "<p>Bring <b>Go</b> along.</p>": "Bring Go along.",
        "good   \n\n  morning": "good morning",
        "": None,
        None: None,
        "<p></p>": None,
        "we do R&D": "we do R&D",
        "a < b and c > d": "a < b and c > d",
        "&amp;lt;b&amp;gt; &eacute;&#233;&#xE9; &unknown; &copy": "&lt;b&gt; ééé &unknown; ©",
        "R&ampD &amp": "R&D &",
        '<script>var t="</p>";go()</script>after<!-- <b>note</b> -->': 'var t="</p>";go() after',
        '<a title="x>y" href=\'a>b\'>link</a>': "link",
        "tail <b attr": "tail",
        "a<script>never <b>closed": "a never <b>closed",
        "<!DOCTYPE html><?php x ?>text here": "text here",
    }
    assert apply(X.clean_html, list(cases)) == list(cases.values())


def test_clean_html_can_drop_scripts(apply):
    value = "a<script>1</script><style>p{}</style>b"
    assert apply(lambda c: X.clean_html(c, drop_script=True), [value]) == ["a b"]


def test_clean_html_agrees_with_the_exact_mode_on_whole_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = F.col("html")
    both = pages.select(X.clean_html(html).alias("a"), X.clean_html(html, exact=True).alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_extract_years(apply):
    cases = {
        "Requires 3+ years of experience.": 3,
        "3-5 years of experience required.": 3,
        "4 to 6 years work experience": 4,
        "Minimum of 4 years in data science.": 4,
        "At least 2 years of work experience.": 2,
        "5 years of industry experience": 5,
        "15 years in business": None,
        "No experience required.": None,
        "99999999999 years of experience": None,
        None: None,
    }
    assert apply(X.extract_years, list(cases)) == list(cases.values())


@pytest.mark.parametrize(
    ("title", "years", "label"),
    [
        ("Senior Data Scientist", 1, "Senior"),
        ("Data Science Internship", None, "Intern"),
        ("Principal Data Scientist", None, "Lead"),
        ("Director of Data Science", None, "Director+"),
        ("Senior Manager", None, "Senior"),
        ("Associate Director", None, "Junior"),
        ("International Analyst", None, "Mid"),
        ("Data Scientist", 1, "Junior"),
        ("Data Scientist", 4, "Mid"),
        ("Data Scientist", 7, "Senior"),
        ("Data Scientist", 12, "Lead"),
        ("Data Scientist", 100, "Mid"),
        (None, None, "Mid"),
    ],
)
def test_classify_by_rules(spark, title, years, label):
    row = spark.range(1).select(X.classify_by_rules(F.lit(title).cast("string"), F.lit(years).cast("int")))
    assert row.first()[0] == label


def test_strip_accents(apply):
    values = ["Québec", "Montréal", "Trois-Rivières", "é", "ộ Ñ ç Å", "straße", "plain", "", None]
    assert apply(X.strip_accents, values) == [
        "Quebec", "Montreal", "Trois-Rivieres", "e", "o N c A", "straße", "plain", "", None,
    ]


def test_extract_tags(apply):
    values = ["Python, SQL and python", "R&D", "JavaScript bread", "Power BI; A/B Testing; scikit-learn.", "", None]
    assert apply(X.extract_tags, values) == [
        ["python", "sql"], ["r"], [], ["a/b testing", "power bi", "scikit-learn"], [], [],
    ]


def _tags_by_definition(text: str, taxonomy: list[str]) -> list[str]:
    pattern = re.compile(r"\b(" + "|".join(re.escape(t) for t in taxonomy) + r")\b", re.IGNORECASE)
    return sorted({m.lower() for m in pattern.findall(text)})


@pytest.mark.parametrize(
    "taxonomy",
    [
        lookups.TAXONOMY,
        ["spark", "spark streaming", "streaming media", "media"],
        ["a b", "b c", "c"],
        ["sql", "no sql"],
    ],
)
def test_extract_tags_equals_one_alternation(apply, taxonomy):
    rng = random.Random(5)
    pieces = [*taxonomy, *(t.upper() for t in taxonomy), "the", "-", "/", ",", "é", "x", "sqlite", "a", "b", "c"]
    texts = [rng.choice(["", " ", "  "]).join(rng.choices(pieces, k=12)) for _ in range(150)]
    texts += [" ".join(rng.choices(pieces, k=12)) for _ in range(150)]
    found = apply(lambda c: X.extract_tags(c, taxonomy), texts)
    assert found == [_tags_by_definition(t, taxonomy) for t in texts]


def test_infer_location_from_text(apply):
    cases = {
        "Office in Toronto, ON.": ("Toronto", "Ontario"),
        "based in montreal quebec": ("Montreal", "Quebec"),
        "London on the river": ("London", "Ontario"),
        "move to Halifax, BC": ("Halifax", "Nova Scotia"),
        "Richmond Hill, Ontario or Richmond, BC": ("Richmond Hill", "Ontario"),
        "Montreal, Quebec City, QC": ("Quebec City", "Quebec"),
        "St. John's NL": ("St. John's", "Newfoundland and Labrador"),
        "Fort McMurray Alberta": ("Fort McMurray", "Alberta"),
        "NewToronto ON": ("Toronto", "Ontario"),
        "somewhere , AB and more": (None, "Alberta"),
        "somewhere, ab": (None, None),
        "Montréal, QC": (None, "Quebec"),
        "": (None, None),
    }
    found = apply(X.infer_location_from_text, [*cases, None])
    assert [tuple(f) for f in found[:-1]] == list(cases.values())
    assert found[-1] is None


def test_odd_characters_and_flags(apply):
    assert apply(X.has_odd_characters, ["plain!", "a+b", "é", "$5", None]) == [False, True, True, True, False]
    flags = apply(
        lambda c: X.infer_flag_from_text(F.lit(None).cast("boolean"), c), ["Remote role", "WORK FROM HOME", "office", None]
    )
    assert flags == [True, True, False, False]


def test_years_patterns_run_only_on_texts_with_their_words(spark):
    rows = [("Minimum of 4 YEARS",), ("m\u0131n\u0131mum of 5 years",), ("at lea\u017ft 6 years",), ("AT LEAST 7 years",), ("8 years here",)]
    df = spark.createDataFrame(rows, "v string").select(X.extract_years(F.col("v")).alias("n"))
    assert [r.n for r in df.collect()] == [4, 5, 6, 7, None]
    assert df._jdf.queryExecution().analyzed().toString().count("Contains(lower(v") == len(lookups.YEARS_PATTERNS)


def test_terms_are_put_together_by_their_first_character(apply):
    terms = ["spark", "sql", "r", "spark streaming", "a/b", "\u00e9t\u00e9"]
    pattern = X._alternation(terms)
    assert pattern.count("s(?:") == 1 and len(re.findall(r"\|(?=[^|]*\(\?:)", pattern)) == 3
    rng = random.Random(3)
    texts = [rng.choice([" ", ""]).join(rng.choices([*terms, "x", "-"], k=8)) for _ in range(80)]
    plain = re.compile(r"\b(" + "|".join(map(re.escape, terms)) + r")\b")
    assert apply(lambda c: X.extract_tags(c, terms), texts) == [sorted(set(plain.findall(t))) for t in texts]
