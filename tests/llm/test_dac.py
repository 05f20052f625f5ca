from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sluicework.llm import dac
from sluicework.llm.queries import QUERIES, tokenizer_path
from tests.llm.messy import ROWS, empty, messy

FOLDER = "/root/testdata/sf0.001"


def reference(rows):
    model, start, out = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), 0, []
    for i, t in rows:
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_tokenizer(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op3_token_files"](spark, FOLDER).orderBy("start").collect()]
    assert got == reference(rows)


@pytest.mark.parametrize("text", ["it's  He'll\n\nDON'T", "ça «va» été", "a\x1cb\x85c d", "<|endoftext|> x<|startoftext|>", "Σίσυφος ΟΔΟΣ", "é ́x", "12 345-6 😀👍🏽", "'s 't!!'re"])
def test_words_in_a_row_equal_the_whole_text(text):
    model = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    assert dac.tokenize(text, tokenizer_path("word_bpe_49k.json"), 2).tolist() == [*model.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("high", [1, 2, 300, 49_408, 2**32])
def test_files_give_any_token(high):
    random = np.random.default_rng(high)
    ids = np.minimum(random.zipf(1.3, 5000), high - 1).astype(np.uint32) if high > 2 else random.integers(0, high, 5000).astype(np.uint32)
    lengths = [0, 1, 1999, 2000, 1000]
    file = dac.TokenFile(pa.BufferReader(dac.encode_file([None, 1, 2, 3, 9], lengths, ids)))
    assert file.n_tokens == 5000 and file.doc_ids == [None, 1, 2, 3, 9]
    assert file.read(0, 5000).tolist() == ids.tolist()
    for place in random.integers(0, 5000, 200).tolist():
        assert file.token(place) == ids[place]
    for a, b in np.sort(random.integers(0, 5001, (50, 2)), axis=1).tolist():
        assert file.read(a, b).tolist() == ids[a:b].tolist()
    assert file.document(2).tolist() == ids[1:2000].tolist()
    with pytest.raises(IndexError):
        file.read(0, 5001)


def test_widths_are_the_cheapest():
    assert sum(dac.level_widths(np.arange(200, dtype=np.uint32))) == 8
    assert dac.level_widths(np.zeros(0, dtype=np.uint32)) == [1]
    skewed = np.concatenate([np.full(10_000, 3), [60_000]]).astype(np.uint32)
    assert dac.level_widths(skewed)[0] == 2


def test_files_are_cut(spark, monkeypatch):
    """Parts of several files: starts go on across files and parts."""
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(300)]
    monkeypatch.setattr(dac, "TOKENS_AT_ONCE", 5)
    got = dac.token_index(spark.createDataFrame(rows[::-1], "doc_id long, text string"), tokenizer_path("word_bpe_49k.json"))
    assert sorted(tuple(r) for r in got.collect()) == reference(rows)


def test_messy_rows(spark):
    got = dac.token_index(messy(spark), tokenizer_path("word_bpe_49k.json")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (i is None, i or 0, n, c) for i, _, n, c in reference([(i, t) for i, t, _ in ROWS])
    )
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    assert [r.doc_id for r in ordered if r.doc_id is not None] == sorted(i for i, *_ in ROWS if i is not None)
    assert dac.token_index(empty(spark), tokenizer_path("word_bpe_49k.json")).count() == 0
