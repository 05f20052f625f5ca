from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sluicework.llm import components, simhash
from sluicework.llm.queries import QUERIES
from tests.llm.messy import ROWS, empty, messy

FOLDER = "/root/testdata/sf0.001"


def fingerprint(text, words=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints, most=2):
    """Smallest id reachable, by comparing all pairs."""
    ids = sorted(prints)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= most and root[b] > root[a]:
                    root[b], changed = root[a], True
    return root


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    prints = {i: fingerprint(t) for i, t in texts.items()}
    roots = components_of(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, FOLDER).collect()}
    assert got == {i: (f"{p:016x}", roots[i]) for i, p in prints.items()}


def test_links_equal_brute_force_on_dense_fingerprints(spark):
    """Chains and clouds of fingerprints a bit or two apart: what a large group of near copies looks like."""
    random = np.random.default_rng(3)
    prints = {}
    for c in range(6):
        now = int(random.integers(0, 1 << 63))
        for i in range(40):
            if c % 2:
                now ^= 1 << int(random.integers(0, 63))
                prints[c * 100 + i] = now
            else:
                prints[c * 100 + i] = now ^ sum(1 << int(b) for b in random.choice(63, int(random.integers(0, 4)), replace=False))
    fps = spark.createDataFrame(list(prints.items()), "rep long, fp long")
    distinct = fps.groupBy("fp").agg(F.min("rep").alias("rep")).select("rep", "fp")
    for parts in ([([*range(22)], 0), ([*range(22, 43)], 0), ([*range(43, 64)], 0)], [([*range(32)], 1), ([*range(32, 64)], 0)]):
        found = simhash.candidates(distinct, parts)
        roots = {r.member: r.root for r in components.connected_components(simhash.links(found, 2), "rep", "low").collect()}
        expected = components_of({r.rep: r.fp & ((1 << 64) - 1) for r in distinct.collect()})
        assert {i: roots.get(i, i) for i in expected} == expected


def test_thresholds_keep_the_pigeonhole():
    for widths in ([32, 32], [21, 21, 22], [16] * 4):
        for agreeing in ([0.0] * 4, [1e9, 1.0, 1.0, 1.0], [5.0, 1e6, 1e6, 1e6]):
            _, chosen = simhash.allocate(1000, widths, agreeing[: len(widths)], 2)
            assert sum(chosen) == 2 - len(widths) + 1 and min(chosen) >= -1


def test_messy_rows(spark):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(messy(spark)).collect())
    prints = {i: fingerprint(t) for i, t, _ in ROWS if i is not None}
    roots = components_of(prints)
    same = {p: roots[i] for i, p in prints.items()}
    expected = [(i is None, i or 0, f"{fingerprint(t):016x}", roots[i] if i is not None else same.get(fingerprint(t))) for i, t, _ in ROWS]
    assert got == sorted(expected, key=lambda r: r[:3])
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 530)] + [(7, 7), (None, 3), (900, 800), (800, 900), (800, 850)]
    got = {r.member: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 500 for i in range(501, 530)}, 850: 800, 900: 800}
