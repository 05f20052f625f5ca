"""Collocations against a plain count of all phrases."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from sluicework.llm import collocations
from sluicework.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm.messy import ROWS, empty, messy

FOLDER = "/root/testdata/sf0.001"


def brute(rows, longest=5, least=100, percent=100, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        counts = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text or ""):
            words = [re.sub("[A-Z]+", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09]+", piece)]
            n[lang] += len(words)
            counts.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        standing = Counter()
        for p, a in found.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        standing[p[i:j]] = max(standing[p[i:j]], a)
        rows = []
        for p, a in found.items():
            if standing[p] and 100 * standing[p] >= percent * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((score, a, " ".join(p), left, right))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, left, right, n[lang], s) for i, (s, a, p, left, right) in enumerate(rows[:top])]
    return sorted(out)


def rows_of(result):
    return sorted(tuple(r) for r in result.collect())


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.lang, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_query_equals_brute_force_and_sql(spark, texts):
    got = QUERIES["op11_collocations"](spark, FOLDER)
    assert rows_of(got) == brute(texts)
    con = connect(FOLDER)
    assert difference(got.toPandas(), con.execute(ORACLES["op11_collocations"]).df()) == ""
    con.close()


@pytest.mark.parametrize("small", [collocations.BROADCAST_ROWS, 0])
def test_both_joins_give_the_same(spark, texts, small):
    """Frequent groups that are broadcast, and those that are shuffled."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = collocations.collocations(docs, longest=4, least=20, percent=90, top=50, small=small)
    assert rows_of(got) == brute(texts, 4, 20, 90, 50)


def test_relations_are_merged_without_an_exchange(spark):
    docs = spark.createDataFrame([("a b c d a b c d",)] * 30, "text string").selectExpr("text", "'en' AS lang")
    relation = collocations.Relation(spark, 10)
    words = collocations.pieces(docs).selectExpr("piece", "1 AS next", "2L AS phrase")
    with collocations._settings(spark, collocations.MERGE_SETTINGS):
        stored = relation.store(relation.dealt(words))
        plan = collocations._extended(stored, stored)._jdf.queryExecution().executedPlan().toString()
    relation.forget()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_long_products_are_exact(spark):
    every = spark.createDataFrame([("en", "a", 1, 10**14), ("en", "b", 1, 10**14), ("en", "a b", 2, 10**14 - 1)], "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 10**16)], "lang string, n long")
    (row,) = collocations.scored(every, totals).collect()
    assert row.score == 1000 * (10**14 - 1) * 10**16 // 10**28


def test_messy_rows(spark):
    plain = [(lang, t) for _, t, lang in ROWS] + [(None, "A b A b a b"), (None, "É é. É é. É é"), ("en", "x\x00y x\x00y, x\x00y x\x00y")]
    more = spark.createDataFrame(plain[len(ROWS) :], "lang string, text string")
    docs = messy(spark).unionByName(more, allowMissingColumns=True)
    got = collocations.collocations(docs, least=2, percent=70)
    assert rows_of(got) == brute(plain, 5, 2, 70)
    assert collocations.collocations(empty(spark)).count() == 0
