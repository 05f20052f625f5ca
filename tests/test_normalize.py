from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from sluicework.functions import lookup as L
from sluicework.functions import normalize as N


def test_places(apply):
    assert apply(N.normalize_province, ["ON", " québec ", "B.C.", "PEI", "Bavière", "", "  ", None]) == [
        "Ontario", "Quebec", "British Columbia", "Prince Edward Island", "Baviere", None, "", None,
    ]
    assert apply(N.normalize_city, ["Montréal", "Downtown", "Greater Vancouver", "York Region", " region", "", None]) == [
        "Montreal", None, "Vancouver", "York", "region", None, None,
    ]
    assert apply(N.normalize_country, ["CA", "canada ", "US", "", "  ", None]) == [
        "Canada", "Canada", "US", "Anywhere", "Anywhere", "Anywhere",
    ]
    assert apply(N.normalize_employment_type, ["FULL_TIME", "Full Time", "Contractor", " casual ", "", None]) == [
        "Full-time", "Full Time", "Contract", "casual", None, None,
    ]
    assert apply(N.province_of_city, ["Montréal", "TORONTO", "Paris", None]) == ["Quebec", "Ontario", None, None]


def test_split_location(apply):
    values = ["Toronto, ON, Canada", "A, B, C, D", "Ontario, Canada", "Canada", "", None]
    found = [tuple(v) if v else (None, None, None) for v in apply(N.split_location, values)]
    assert found == [
        ("Toronto", "ON", "Canada"), ("A", "C", "D"), (None, "Ontario", "Canada"), (None, None, "Canada"),
        (None, None, None), (None, None, None),
    ]


def test_split_area(apply):
    values = [["Canada", "Ontario", "Toronto"], ["Canada", "BC"], [], None, ["Canada", "ON", "York", "Markham"]]
    found = [tuple(v) for v in apply(N.split_area, values, "array<string>")]
    assert found == [
        ("Toronto", "Ontario", "Canada"), (None, "BC", "Canada"), (None, None, "Canada"), (None, None, "Canada"),
        ("Markham", "ON", "Canada"),
    ]


def test_pay(apply):
    cases = {
        "CA$90,000–$120,000 a year": (90000.0, 120000.0, "YEAR"),
        "$45–$55 an hour": (45.0, 55.0, "HOUR"),
        "CA$80K a year": (80000.0, None, "YEAR"),
        "$5,000 a month": (5000.0, None, "MONTH"),
        "90–120K": (90.0, 120000.0, None),
        "20 to 30 an hour": (20.0, 30.0, "HOUR"),
        "Competitive": (None, None, None),
        ",": (None, None, None),
    }
    ranges = [tuple(r) for r in apply(N.parse_salary_range, list(cases))]
    periods = apply(N.parse_salary_period, list(cases))
    assert [(*r, p) for r, p in zip(ranges, periods)] == list(cases.values())
    assert apply(N.parse_salary_range, [None]) == [None] or apply(N.parse_salary_range, [None])[0]["low"] is None


def test_annualize(spark):
    rows = spark.createDataFrame(
        [(45.0, "HOUR"), (240.39, "HOUR"), (5000.0, "MONTH"), (900000.0, "YEAR"), (50.0, None), (None, "HOUR")],
        "a double, p string",
    )
    got = rows.select(N.annualize(F.col("a"), F.col("p")), N.annual_period(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [
        (93600.0, "YEAR"), (None, "YEAR"), (5000.0, "MONTH"), (900000.0, "YEAR"), (50.0, "YEAR"), (None, "YEAR"),
    ]


@pytest.mark.parametrize("now", ["2024-03-12 15:00:00", "2024-11-04 05:30:00", "2024-07-01 00:00:00"])
def test_relative_time_is_a_wall_clock_shift(apply, now):
    """The expected instants come from the standard library's zone arithmetic."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    cases = [(3, "days"), (2, "weeks"), (5, "hours"), (1, "day"), (90, "minutes"), (40, "seconds"), (36, "hours")]
    zone = ZoneInfo("America/Toronto")
    local = datetime.fromisoformat(now).replace(tzinfo=ZoneInfo("UTC")).astimezone(zone)
    expected = []
    for n, unit in cases:
        past = local - timedelta(seconds=n * units[unit.rstrip("s")])
        expected.append(past.astimezone(ZoneInfo("UTC")).strftime("%Y-%m-%d %H:%M:%S"))
    as_of = F.lit(now).cast("timestamp")
    got = apply(
        lambda c: F.date_format(N.relative_to_timestamp(c, as_of), "yyyy-MM-dd HH:mm:ss"),
        [f"{n} {unit} ago" for n, unit in cases],
    )
    assert got == expected


def test_other_times(apply):
    as_of = F.lit("2024-03-12 15:00:00").cast("timestamp")
    values = ["Just posted", "30+ days ago", "1 month ago", "99999999999 weeks ago", None, "2026-03-01T10:00:00Z", "2026-03-01", "nonsense", ""]
    got = apply(lambda c: F.date_format(N.parse_posted_at(c, as_of), "yyyy-MM-dd HH:mm"), values)
    assert got == [None] * 5 + ["2026-03-01 10:00", "2026-03-01 00:00", None, None]


def test_normalize_domain(apply):
    cases = {
        "https://www.example.com/jobs": "example.com",
        "careers.acme.io": "careers.acme.io",
        "HTTP://X.com": "http:",
        "https://Acme.io:8080/a b?x": "acme.io:8080",
        "httpbin.org/x": "httpbin.org/x",
        "https://[broken/x": None,
        "https://": None,
        "": None,
        None: None,
    }
    assert apply(N.normalize_domain, list(cases)) == list(cases.values())


def test_display(apply):
    assert apply(L.display_percent, [42.5, 43.5, None], "double") == ["42%", "44%", "—"]
    assert apply(L.display_thousands, [81234.4, None], "double") == ["$81k", "—"]
    assert apply(L.display_count, [1234567, None], "bigint") == ["1,234,567", "—"]
    assert apply(L.display_count, [1999.9, -1999.9], "double") == ["1,999", "-1,999"]
    assert apply(L.display_money, [1234.5], "double") == ["$1,234"]


@pytest.mark.parametrize("size", [1, 300, 5000])
def test_lookup_in_tables_of_any_size(apply, size):
    table = {f"é{i}": i for i in range(size)}
    assert apply(lambda c: L.lookup(c, table), [f"é{size - 1}", "é0", "other", None]) == [size - 1, 0, None, None]
