"""The registered queries of this package, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm import cgk, collocations, dac, htmltext, licenses, mtree, resampling, secrets, simhash, spm, suffix, toxicity, urls
from sluicework.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its own name."""

    def register(build):
        QUERIES[build.__name__] = lambda spark, folder: build(prepare(spark), folder.rstrip("/"))
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, up to 2 differing bits."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def tokenizer_path(name: str) -> str:
    """Where the installed vocabulary files lie; the operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query()
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, written to files of directly addressable codes and read back."""
    return dac.token_index(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labelled rows outside fold 0."""
    found = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "rejected",
    )


@query()
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents, up to a tenth of their characters edited."""
    return cgk.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents, and the texts that they decode to."""
    return spm.round_trip(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


HOST_RULES = (
    urls.host_rule("allow", "com"),
    urls.host_rule("block", "example.com", "/en/"),
    urls.host_rule("allow", "www.example.com", "/en/"),
    urls.host_rule("block", "net", "/es/"),
    urls.host_rule("block", "net", "/fr/"),
)


@query(urls.sql_twin((*HOST_RULES, *urls.SPAM_RULES)))
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on the URLs of all pages: the host rules, else the method's."""
    found = urls.filter_urls(table(spark, folder, "pages"), (*HOST_RULES, *urls.SPAM_RULES))
    return found.select("page_id", "host", "path", F.when(F.col("tier") == 1, F.col("rule")).alias("rule"), "verdict")


@query(secrets.sql_twin())
def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents: certain spans, and weak ones beside their complement."""
    found = secrets.scan(table(spark, folder, "documents"))
    counts = [secrets.count_of("base", kind).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS[:3]]
    digest = F.sha2(secrets.shown(F.col("base")), 256).alias("base_sha256")
    return found.select("doc.doc_id", *counts, digest, secrets.shown(F.col("spans")).alias("spans"))


@query()
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of all documents without the strings of 50 bytes that start in earlier ones."""
    return suffix.remove_repeats(table(spark, folder, "documents")).drop("kept")


TOP_K_SQL = """
WITH whole AS (SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query(TOP_K_SQL)
def op4_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five best partners of every fiftieth vector, by inner product of whole numbers."""
    return mtree.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The visible text of all pages."""
    return htmltext.extract_pages(table(spark, folder, "pages"))


@query(collocations.sql_twin())
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of each language, from all documents."""
    return collocations.collocations(table(spark, folder, "documents"))


@query(licenses.sql_twin())
def op12_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and templates in all documents."""
    return licenses.digest(licenses.scan(table(spark, folder, "documents")))


@query(resampling.sql_twin())
def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of all documents, drawn towards the benchmark's words."""
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
