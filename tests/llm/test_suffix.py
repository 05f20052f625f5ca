from __future__ import annotations

import hashlib

import numpy as np
import pytest

from sluicework.llm import sais, suffix
from sluicework.llm.queries import QUERIES
from tests.llm.messy import ROWS, empty, messy

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    """By the definition: every string of 50 bytes, with the smallest id that holds it."""
    low: dict[bytes, int] = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, raw in texts:
        for p in range(len(raw) - 49 if i is not None else 0):
            low[raw[p : p + 50]] = min(low.get(raw[p : p + 50], i), i)
    out = []
    for i, raw in texts:
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - 49 if i is not None else 0):
            if low[raw[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i is None, i or 0, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert result(QUERIES["op8_suffix_dedup"](spark, FOLDER)) == brute(rows)


def test_many_chunks_and_runs(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK_BYTES", 2000)
    random = np.random.default_rng(5)
    shared = ["".join(random.choice(list("ab é"), 70)) for _ in range(4)] + ["x" * 120, "ab" * 60]
    rows = [(int(i), "".join(random.choice(list("abcdefgh "), 30)).join(random.choice(shared, 4))) for i in random.integers(0, 60, 120)]
    rows += [(60, "y" * 49), (61, "y" * 50), (62, "y" * 51), (62, "y" * 51), (63, "z" * 200)]
    assert result(suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_messy_rows(spark):
    assert result(suffix.remove_repeats(messy(spark))) == brute([(i, t) for i, t, _ in ROWS])
    assert suffix.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("kinds", [1, 2, 3, 5])
def test_suffix_arrays_equal_sorting(kinds):
    random = np.random.default_rng(kinds)
    for size in [1, 2, 3, 10, 50, 400] * 10:
        t = np.concatenate([random.integers(1, kinds + 1, size), [0]]).astype(np.uint8)
        s = t.tobytes()
        assert sais.suffix_array(t, kinds + 1).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_recursion_and_doubling_agree(monkeypatch):
    random = np.random.default_rng(1)
    t = np.concatenate([np.tile(random.integers(1, 6, 300), 5), [0]]).astype(np.uint8)
    one = sais.suffix_array(t, 6)
    monkeypatch.setattr(sais, "MOST_BUCKETS", 0)
    assert sais.suffix_array(t, 6).tolist() == one.tolist()


def test_common_prefixes():
    data = np.frombuffer(b"abcabcabcabd" + b"\0" * 20, dtype=np.uint8)
    order = np.array(sorted(range(7), key=lambda i: data.tobytes()[i:]))
    for length in (3, 5, 8, 9):
        raw = data.tobytes()
        expected = [False] + [raw[a : a + length] == raw[b : b + length] for a, b in zip(order, order[1:], strict=False)]
        assert sais.prefixes_reach(data, order, length).tolist() == expected


def test_doubling_sorts_again_only_what_is_not_yet_in_order(monkeypatch):
    random = np.random.default_rng(3)
    ranks = np.concatenate([random.permutation(6000) + 2, np.ones(300, dtype=np.int64), random.integers(2, 40, 300), [0]])
    text, sorted_rows, argsort = ranks.tolist(), [], np.argsort
    monkeypatch.setattr(sais.np, "argsort", lambda a, *args, **more: sorted_rows.append(len(a)) or argsort(a, *args, **more))
    found = sais._by_doubling(ranks)
    assert found.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    assert sum(sorted_rows) < len(text)


def test_equal_segments_of_a_chunk_carry_the_smallest_id():
    shared = "".join(np.random.default_rng(8).choice(list("abcdefgh"), 90))
    chunk = suffix.chunk_of([(9, shared), (4, shared), (7, "-" + shared), (4, shared)])
    segments, which, low, _ = suffix._segments(chunk, np.ones(len(chunk.first), dtype=bool))
    docs = [chunk.ids[d] for d in chunk.doc]
    assert low.tolist() == [min(d for d, w in zip(docs, which.tolist()) if w == k) for k in range(len(segments))]


def test_windows_are_taken_a_block_at_a_time(monkeypatch):
    random = np.random.default_rng(9)
    data = random.integers(97, 100, 700).astype(np.uint8)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    plain = suffix._mixed(sais.words_at(padded)[:-8])
    upper, size = plain & ~suffix.PLACE, suffix.WINDOW
    expected = [p + int(np.argmin(upper[p : p + size])) for p in range(len(data) - size + 1)]
    longest, minimum = [], np.minimum
    monkeypatch.setattr(suffix, "BLOCK", 64, raising=False)
    monkeypatch.setattr(suffix.np, "minimum", lambda a, b: longest.append(len(a)) or minimum(a, b))
    texts = [data[:300].tobytes().decode(), "", "short", data[300:].tobytes().decode(), "a" * 49]
    chunk = suffix.chunk_of(list(enumerate(texts)))
    assert max(longest) < 64 + size
    ends = chunk.starts[chunk.doc + 1]
    assert all(chunk.first + chunk.count + suffix.LENGTH - 1 <= ends)
    assert chunk.count.sum() == sum(max(len(t) - suffix.LENGTH + 1, 0) for t in texts)
    hashes, places = suffix._least(data)
    assert hashes.tolist() == plain.tolist() and places.tolist() == expected
