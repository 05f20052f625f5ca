from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluicework.llm import spm
from sluicework.llm.queries import QUERIES, tokenizer_path
from tests.llm.messy import ROWS, empty, messy

FOLDER = "/root/testdata/sf0.001"
CASES = ["", " ", "  x  y ", "trail  ", "日本語 текст 😀😀 \n\n\tz", "Ω≈ç√", "\x00\x01", "Hello, world. It's 1,234.5!", "aaaaaaaaaaaaaaaa" * 20, "re.\nErtion"]


@pytest.fixture(scope="module")
def codec():
    return spm.Codec(tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library(codec):
    """The library's own unigram encoder, with the same pieces and scores."""
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for i, score in codec.pieces.scores.items():
        proto.pieces[i].score = score
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


@pytest.mark.parametrize("text", CASES)
def test_encoding_equals_the_library(codec, library, text):
    assert codec.encode(text).tolist() == library.encode(text)


def best_score(codec, text):
    """The best segmentation's score by trying all pieces at all places."""
    names = {n: codec.pieces.scores[i] for i, n in codec.pieces.names.items()}
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 20), end):
            if text[start:end] in names:
                best[end] = max(best[end], best[start] + names[text[start:end]])
        if text[end - 1] not in names:
            best[end] = max(best[end], best[end - 1] + codec.pieces.unknown)
    return best[-1]


@pytest.mark.parametrize("text", ["▁internationalization", "▁qwxzy,,", "▁été日🙃é", "▁a🙃🙃b"])
def test_segmentation_has_the_best_score(codec, text):
    ids = codec.segment(text)
    known = {i: s for i, s in codec.pieces.scores.items()}
    bytes_ids = set(codec.pieces.bytes.values())
    unknown = sum(c not in codec._single for c in text)
    score = sum(known[i] for i in ids if i not in bytes_ids) + unknown * codec.pieces.unknown
    assert score == best_score(codec, text)


@pytest.mark.parametrize("text", [*CASES, "▁a ▁", "a▁▁ b"])
def test_round_trip(codec, text):
    assert codec.decode(codec.encode(text).tolist()) == text


def test_odd_ids(codec):
    assert codec.decode([]) == ""
    assert codec.decode([10**6]) == "⁇ "
    assert codec.decode([1, 2]) == ""


def test_query_gives_all_texts_back(spark):
    got = QUERIES["op1_sentencepiece"](spark, FOLDER)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    codec = spm.codec(tokenizer_path("piece_bpe_32k.model"))
    rows = got.collect()
    assert {r.doc_id: r.decoded for r in rows} == texts and all(r.same for r in rows)
    assert all(r.ids == codec.encode(texts[r.doc_id]).tolist() and r.n_ids == len(r.ids) for r in rows)


def test_messy_rows(spark):
    rows = spm.round_trip(messy(spark), tokenizer_path("piece_bpe_32k.model")).collect()
    assert sorted((r.decoded is None, r.decoded or "") for r in rows) == sorted((t is None, t or "") for _, t, _ in ROWS)
    assert all(r.same and (r.ids is None) == (r.decoded is None) for r in rows)
    assert spm.round_trip(empty(spark), tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_nulls_within_ids(spark):
    got = spark.createDataFrame([([1, None, 2],), (None,), ([],)], "ids array<int>")
    assert [r[0] for r in got.select(spm.decode(tokenizer_path("piece_bpe_32k.model"), F.col("ids"))).collect()] == ["", None, ""]
