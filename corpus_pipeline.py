"""A corpus pipeline: toxicity, near-duplicates, benchmark decontamination, secrets, token ids.

Each stage is a function ``(spark, docs, sf_dir)`` that gets all its predecessor kept and returns a DataFrame; all but
the last return the columns of ``docs``. Null and empty texts, repeated rows, empty tables and further columns are fine
at every stage; what becomes of them is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.llm import cgk, secrets, simhash, spm, toxicity
from sluicework.llm.common import stored
from sluicework.llm.queries import table, tokenizer_path
from sluicework.session import prepare


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject.

    It learns from the labelled rows among ``docs`` and rejects from the threshold of a document's language on. Without
    labels nothing is rejected. A null text is scored like an empty one.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score(docs, model) < toxicity.threshold(model))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id. Documents are linked when the
    SimHash fingerprints of their three-word shingles differ in 2 bits or fewer.

    Rows with the same id are one document, of which one row stays. Rows without an id come after those with one, in
    the order of a hash of their text.
    """
    unnamed = F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 61) - 1))
    key = F.coalesce(F.col("doc_id").cast("long"), unnamed)
    found = simhash.near_duplicates(docs.select(key.alias("doc_id"), "text"), words=3, most=2)
    first = stored(found.filter("doc_id = component_id").select(F.col("doc_id").alias("key")).distinct(), "first")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), key.alias("key")).join(first, "key", "left_semi")
    order = Window.partitionBy("key").orderBy(F.xxhash64("doc"))
    return rows.withColumn("place", F.row_number().over(order)).filter("place = 1").select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item in them; those with a null or empty text stay."""
    return docs.filter(~cgk.is_contaminated(docs, table(spark, sf_dir, "benchmark")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret, and the length of the new text where there is one."""
    found, text = secrets.scan(docs), F.col("doc.text")
    changed = secrets.redacted(text, F.col("spans"))
    new = {"text": changed, "n_chars": F.when(F.size("spans") > 0, F.length(changed)).otherwise(F.col("doc.n_chars"))}
    return found.select(*((new[c] if c in new else F.col("doc")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their text, and whether these decode to the text again."""
    path = tokenizer_path("piece_bpe_32k.model")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"))
    rows = rows.withColumn("code", spm.recode(path, F.col("doc.text")))
    same = F.col("code.decoded").eqNullSafe(F.col("doc.text"))
    return rows.select("doc.doc_id", "doc.lang", "doc.source", "doc.text", "code.ids", same.alias("same"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("sentencepiece", to_token_ids),
]

# SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read again by the next stage."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
