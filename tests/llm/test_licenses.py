"""License scans against every block compared with every template."""

from __future__ import annotations

import re
from fractions import Fraction

from sluicework.llm import licenses
from sluicework.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm.messy import ROWS, empty, messy

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def brute(text, phrases=licenses.PHRASES, templates=licenses.TEMPLATES, share=licenses.SHARE):
    words = words_of(text or "")
    places = []
    for phrase, label in phrases.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    lines, hits = (text or "").split("\n"), []
    for i, line in enumerate(lines):
        block = set(words_of(line + " " + (lines[i + 1] if i + 1 < len(lines) else "")))
        for label, template in templates:
            whole = set(words_of(template))
            common = Fraction(len(whole & block), len(whole))
            if common >= share:
                hits.append((float(common), label))
    base = sorted({label for _, label in places})
    both = sorted({*base, *(label for _, label in hits)})
    starts = [s for s, _ in places]
    score = 1.0 if places else max((s for s, _ in hits), default=0.0)
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(both), score


def rows_of(digest):
    return sorted((tuple(r) for r in digest.collect()), key=repr)


def test_query_equals_sql_and_brute_force(spark):
    got = QUERIES["op12_licenses"](spark, FOLDER)
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert rows_of(got) == sorted(((r.doc_id, *brute(r.text)) for r in texts), key=repr)
    assert got.filter("labels <> ''").count() > 20
    con = connect(FOLDER)
    assert difference(got.toPandas(), con.execute(ORACLES["op12_licenses"]).df()) == ""
    con.close()


TEXTS = [
    "CC BY, cc-by; cc by\ncc\nby general public general public license",
    "all rights all rights reserved. ALL RIGHTS RESERVED",
    "Redistribution and use in source and\nbinary forms, with or without modification, are permitted.",
    "Redistribution and use in source\nand binary forms, with or\nwithout modification, are permitted.",
    "released under the license of MIT",
    "you may not use this file except in compliance with a permit",
    "licensed under apache license " * 2000 + "the",
    "cc by " * 300_000,
    "no license here",
]


def test_cases(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert rows_of(licenses.digest(licenses.scan(docs))) == sorted(((i, *brute(t)) for i, t in enumerate(TEXTS)), key=repr)


def test_filters_lose_no_block(spark):
    """Many templates of common words with a low share: long prefixes, and all three filters at work."""
    templates = tuple((f"t{i}", " ".join(f"w{(i * 7 + j * j) % 23}" for j in range(3 + i % 9))) for i in range(25))
    texts = ["\n".join(" ".join(f"w{(a * b + c) % 29}" for c in range(b % 13)) for b in range(1, 40)) for a in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for share in (Fraction(1, 2), Fraction(7, 10), Fraction(1)):
        got = licenses.digest(licenses.scan(docs, {}, templates, share), {"x": "none"})
        assert rows_of(got) == sorted(((i, *brute(t, {}, templates, share)) for i, t in enumerate(texts)), key=repr)


def test_rare_words_come_first():
    ranks, (template,) = licenses.ordered((("a", "the rare the word"),), {b"the": 50, b"rare": 1, b"word": 9}, Fraction(2, 3))
    assert [w for w, _ in sorted(ranks.items(), key=lambda x: x[1])] == [b"rare", b"word", b"the"]
    assert template == (0, "a", [0, 1, 2], 2)


def test_messy_rows(spark):
    got = licenses.digest(licenses.scan(messy(spark)))
    assert rows_of(got) == sorted(((i, *brute(t)) for i, t, _ in ROWS), key=repr)
    assert licenses.scan(empty(spark)).count() == 0
    bare = licenses.scan(messy(spark), {}, ()).collect()
    assert len(bare) == len(ROWS) and all(r.places == [] and r.found == [] for r in bare)
