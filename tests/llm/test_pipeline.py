"""The stages, each on its own input, and all of them together, against plain Python."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from sluicework.llm import spm, toxicity
from sluicework.llm.queries import tokenizer_path
from tests.llm.messy import ROWS, empty, messy
from tests.llm.test_cgk import brute as leaks
from tests.llm.test_secrets import everything
from tests.llm.test_simhash import components_of, fingerprint

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def redacted(text):
    out, at = "", 0
    for start, end, rank in everything(text):
        if start >= at:
            out += text[at:start] + f"<{('assign', 'access', 'hex', 'named', 'bare', 'endpoint')[rank]}>"
        at = max(at, end)
    return out + text[at:]


def test_the_whole_pipeline_equals_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = [r for r in docs.collect() if toxicity.score_texts([r.text], model)[0] < model.thresholds.get(r.lang, 0.5)]
    roots = components_of({r.doc_id: fingerprint(r.text) for r in rows})
    rows = [r for r in rows if roots[r.doc_id] == r.doc_id]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = {d for d, _ in leaks([(r.doc_id, r.text) for r in rows], items)}
    rows = [r for r in rows if r.doc_id not in found]
    codec = spm.codec(tokenizer_path("piece_bpe_32k.model"))
    expected = {r.doc_id: (redacted(r.text), codec.encode(redacted(r.text)).tolist(), True) for r in rows}
    got = {r.doc_id: (r.text, r.ids, r.same) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == expected


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stages_keep_the_columns(spark, name):
    docs = messy(spark)
    got = STAGES[name](spark, docs, FOLDER)
    assert got.dtypes == docs.dtypes
    assert STAGES[name](spark, empty(spark), FOLDER).count() == 0


def test_near_duplicates_leave_one_of_each_group(spark):
    got = [(r.doc_id, r.text) for r in STAGES["simhash"](spark, messy(spark), FOLDER).collect()]
    ids = sorted(i for i, _ in got if i is not None)
    # The copies of the long text, of the first line, and of the empty one; the last three rows have no id.
    assert ids == [-5, 3, 6, 8, 9, 10, 11, 12]
    assert [t for i, t in got if i is None] == [t for i, t, _ in ROWS if i is None and t]


def test_last_stage_gives_ids_that_decode(spark):
    got = STAGES["sentencepiece"](spark, messy(spark), FOLDER)
    assert got.count() == len(ROWS) and got.filter(~F.col("same")).count() == 0
    assert STAGES["sentencepiece"](spark, empty(spark), FOLDER).count() == 0
