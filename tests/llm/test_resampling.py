"""Resampling against a plain computation of weights, noise and order."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sluicework.llm import common, resampling
from sluicework.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm.messy import ROWS, empty, messy

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, least=1, most=1):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]).encode() for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=10, least_words=20, buckets=10_000, least=1, most=1, seed=2024):
    of = lambda g: zlib.crc32(g) % buckets
    read = [(i, *grams(t, least, most)) for i, t in rows]
    s = Counter(of(g) for *_, found in read for g in found)
    t = Counter(of(g) for x in target for g in grams(x, least, most)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    scored = []
    for i, n, found in read:
        weight = sum(gain(of(g)) for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in scored if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = len(fit) * percent // 100
    ranked = [(r[0], *r[2:], k + 1 if k < drawn else None) for k, r in enumerate(fit)]
    return sorted(ranked + [(r[0], *r[2:], None) for r in scored if r[1] < least_words], key=repr)


def rows_of(result):
    return sorted((tuple(r) for r in result.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    return docs, [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]


def test_query_equals_brute_force_and_sql(spark, tables):
    got = QUERIES["op13_resampling"](spark, FOLDER)
    assert rows_of(got) == brute(*tables)
    con = connect(FOLDER)
    assert difference(got.toPandas(), con.execute(ORACLES["op13_resampling"]).df()) == ""
    con.close()


def test_longer_grams_in_small_chunks(spark, tables, monkeypatch):
    monkeypatch.setattr(resampling, "GRAMS_AT_ONCE", 700)
    docs, target = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "benchmark"))
    got = resampling.resample(docs, target, percent=33, least_words=5, buckets=97, least=2, most=3, seed=7)
    assert rows_of(got) == brute(*tables, 33, 5, 97, 2, 3, 7)


@pytest.mark.parametrize("size", [1, 7, 60])
def test_grams_cross_chunks(monkeypatch, size):
    text = "the cat, the dog and the bird sat; on\nthe mat of theirs"
    monkeypatch.setattr(resampling, "word_chunks", lambda plain: common.word_chunks(plain, size))
    chunks = list(resampling._grams(common.plain_bytes(text), 1, 3))
    assert sorted(g for part, _ in chunks for g in part) == sorted(grams(text, 1, 3)[1])
    assert sum(n for _, n in chunks) == grams(text)[0]


def test_slots_hold_each_gram_once(monkeypatch):
    """Also when all hashes are equal: the bytes decide."""
    words = [b"a", b"b", b"a", b"c", b"b", b"a"] * 5
    for hash_of in (resampling.xxhash.xxh64_intdigest, lambda _: 11):
        monkeypatch.setattr(resampling.xxhash, "xxh64_intdigest", hash_of)
        slots = resampling.Slots(words, 1000)
        by_slot = {s: {w for w, x in zip(words, slots.slot_of, strict=True) if x == s} for s in set(slots.slot_of.tolist())}
        assert sorted(map(sorted, by_slot.values())) == [[b"a"], [b"b"], [b"c"]]
        for s, (word,) in by_slot.items():
            assert slots.count[s] == words.count(word) and slots.bucket[s] == zlib.crc32(word) % 1000
        assert slots.count.sum() == len(words)
    assert resampling.Slots([], 10).count.sum() == 0


def test_gains_without_a_target():
    got = resampling.gains(np.array([3, 0, 1]), np.zeros(3, dtype=np.int64))
    assert got.tolist() == [math.floor(1000 * math.log(7 / ((s + 1) * 3))) for s in (3, 0, 1)]


def test_messy_rows(spark, tables):
    target = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    got = resampling.resample(messy(spark), target, percent=40, least_words=2)
    assert rows_of(got) == brute([(i, t) for i, t, _ in ROWS], tables[1], 40, 2)
    assert resampling.resample(empty(spark), target).count() == 0
    nothing = resampling.resample(messy(spark), target.filter("false"))
    assert rows_of(nothing) == brute([(i, t) for i, t, _ in ROWS], [])
