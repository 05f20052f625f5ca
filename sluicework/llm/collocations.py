"""Phrase collocations by set-oriented mining over occurrence relations.

The relation of length k has a row for every place where a frequent phrase of k words ends: ``(piece, next, phrase)``, with ``next``
the place after it. It is stored sorted, dealt to files by piece, so that a merge join with the words at ``next`` extends all
phrases by a word without moving a row. The extended phrases are counted as groups, and a semi-join with the frequent ones
gives the relation of length k + 1. Parts of a frequent phrase are as frequent, so their counts are all known at the end.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.llm.common import ascii_lower, new_folder, stored

MARKS = r"[.,;:!?\x0A-\x0D]"
BLANKS = r"[\x20\x09]+"
# Rows of a relation in one file, and the most files; beyond them files grow and their sorts spill.
ROWS_A_FILE = 2_000_000
MOST_FILES = 50_000
# Frequent groups up to this number (some 50 MB) are broadcast; more are joined by a shuffle on the group.
BROADCAST_ROWS = 400_000

# Files of a relation are dealt by ``piece`` and sorted: a join by ``piece`` and place needs no exchange of them.
MERGE_SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def pieces(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, piece, content)``: the parts of all texts between marks, in lower case, each with a number of its own."""
    rows = docs.select(F.coalesce(docs[lang], F.lit("und")).alias("lang"), F.explode(F.split(docs[text], MARKS)).alias("content"))
    return rows.select("lang", F.monotonically_increasing_id().alias("piece"), ascii_lower(F.col("content")).alias("content"))


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, phrase, f)`` of all single words."""
    words = pieces(docs, text, lang).select("lang", F.explode(F.split("content", BLANKS)).alias("phrase")).filter("phrase <> ''")
    return words.groupBy("lang", "phrase").agg(F.count("*").alias("f"))


class Relation:
    """Occurrence relations of one run: tables in the shared folder with rows dealt to files by ``piece`` and sorted."""

    def __init__(self, spark: SparkSession, n_rows: int) -> None:
        self._spark = spark
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.files = min(max(least, n_rows // ROWS_A_FILE + 1), MOST_FILES)
        self._names: list[str] = []

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.files, "piece")

    def store(self, rows: DataFrame) -> DataFrame:
        """Write ``(piece, next, phrase)`` and read it back. Rows that are not yet dealt by ``piece`` are dealt first by the caller."""
        name = f"occurrences_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.files, "piece").sortBy("piece", "next").option("path", new_folder(self._spark, "occurrences"))
        writer.saveAsTable(name)
        self._names.append(name)
        return self._spark.table(name)

    def forget(self) -> None:
        """Take the tables out of the catalogue."""
        for name in self._names:
            self._spark.sql(f"DROP TABLE {name}")


def _numbered(groups: DataFrame, name: str) -> DataFrame:
    """Groups with a number of their own, fixed by storing them."""
    return stored(groups.withColumn("id", F.monotonically_increasing_id()), name)


def _extended(now: DataFrame, words: DataFrame) -> DataFrame:
    """``(piece, next, phrase, word)``: every occurrence followed by a frequent word, by a merge join at the place after it."""
    left = now.select("piece", "next", "phrase").hint("merge")
    right = words.select(F.col("piece").alias("of"), (F.col("next") - 1).alias("at"), F.col("phrase").alias("word"))
    found = left.join(right, (F.col("piece") == F.col("of")) & (F.col("next") == F.col("at")))
    return found.select("piece", (F.col("next") + 1).alias("next"), "phrase", "word")


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, text: str = "text", lang: str = "lang", small: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words that occur ``least`` times or more in a language, and the words of each.

    The first table has ``(lang, phrase, words, f)``, the second ``(lang, n)`` with ``n`` counting all word occurrences.
    Up to ``small`` frequent groups of a length are broadcast to the semi-join; more are shuffled by group, and the
    occurrences dealt by piece again.
    """
    spark = docs.sparkSession
    counts = stored(word_counts(docs, text, lang), "word-counts")
    totals = stored(counts.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    known = _numbered(counts.filter(F.col("f") >= least), "phrases-1")
    levels = [known.select("lang", "phrase", F.lit(1).alias("words"), "f")]
    kept = known.agg(F.count("*"), F.sum("f")).first()
    relation = Relation(spark, kept[1] or 0)
    with _settings(spark, MERGE_SETTINGS):
        whole = pieces(docs, text, lang)
        is_small = kept[0] <= small
        words = relation.dealt(whole) if is_small else whole
        words = words.select("lang", "piece", F.posexplode(F.split("content", BLANKS)).alias("next", "phrase")).filter("phrase <> ''")
        ids = known.select("lang", "phrase", "id")
        words = words.join(F.broadcast(ids) if is_small else ids, ["lang", "phrase"])
        words = words.select("piece", (F.col("next") + 1).alias("next"), F.col("id").alias("phrase"))
        now = words = relation.store(words if is_small else relation.dealt(words))
        names = shown = known.select("id", "lang", F.col("phrase").alias("shown"))
        for length in range(2, longest + 1):
            longer = _extended(now, words)
            groups = longer.groupBy("phrase", "word").agg(F.count("*").alias("f")).filter(F.col("f") >= least)
            groups = _numbered(groups, f"groups-{length}")
            n_groups = groups.count()
            if not n_groups:
                break
            last = names.select(F.col("id").alias("word"), F.col("shown").alias("last"))
            spelt = groups.join(shown.select(F.col("id").alias("phrase"), "lang", "shown"), "phrase").join(last, "word")
            spelt = stored(spelt.select("id", "lang", F.concat_ws(" ", "shown", "last").alias("shown"), "f"), f"phrases-{length}")
            levels.append(spelt.select("lang", F.col("shown").alias("phrase"), F.lit(length).alias("words"), "f"))
            shown = spelt.select("id", "lang", "shown")
            if length < longest:
                is_small = n_groups <= small
                frequent = groups.select("phrase", "word", "id")
                found = longer.join(F.broadcast(frequent) if is_small else frequent, ["phrase", "word"])
                found = found.select("piece", "next", F.col("id").alias("phrase"))
                now = relation.store(found if is_small else relation.dealt(found))
    relation.forget()
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return every, totals


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 a n / (l r)), exact: whole numbers of up to 38 digits."""
    wide = {name: F.col(name).cast("decimal(17,0)") for name in (a, n, left, right)}
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide[a] * wide[n], wide[left] * wide[right])


def scored(every: DataFrame, totals: DataFrame, percent: int = 100) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of all phrases of two words or more that no longer phrase stands for.

    A phrase is cut after each of its first words; the cut with the lowest score counts, of equal ones the first. It is
    dropped when a longer phrase that contains it occurs at least ``percent`` per cent as often.
    """
    candidates = every.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = candidates.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", _part(F.col("w"), F.lit(1), F.col("k"))).withColumn("rest", _part(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")))
    for side, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(every.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    cuts = cuts.join(totals, "lang").withColumn("score", _score("a", "n", "l", "r"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    starts = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("start")
    inner = candidates.filter("words > 2").select("lang", "words", "a", "w", starts)
    size = F.explode(F.sequence(F.lit(2), F.least(F.col("words") - 1, F.col("words") - F.col("start") + 1)))
    inner = inner.select("lang", "a", "w", "start", size.alias("size"))
    inner = inner.select("lang", _part(F.col("w"), F.col("start"), F.col("size")).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(F.col("longer") * 100 < F.col("a") * percent, F.lit(True)))
    return left.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def collocations(
    docs: DataFrame, longest: int = 5, least: int = 100, percent: int = 100, top: int = 2000, text: str = "text", lang: str = "lang", small: int = BROADCAST_ROWS
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` best phrases of each language.

    Order: score, then ``a``, both descending, then the phrase by its bytes. Null texts and texts without words have no
    phrases and count no words; a null language is ``und``; repeated rows count as often as they come; an empty table
    gives an empty one; other columns are ignored. A text of any length is read whole, its pieces are dealt apart.
    """
    every, totals = frequent_phrases(docs, longest, least, text, lang, small)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(every, totals, percent).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def sql_twin(longest: int = 5, least: int = 100, percent: int = 100, top: int = 2000, table: str = "documents") -> str:
    """DuckDB text of the same result."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH parts AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({lower}, '{MARKS}')) AS part FROM {table}),
pieces AS (SELECT lang, [x FOR x IN string_split_regex(part, '{BLANKS}') IF x <> ''] AS w FROM parts),
grams AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM pieces, range(1, {longest + 1}) lengths(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {least}),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT c.*, j, array_to_string(w[1:j], ' ') AS p, array_to_string(w[j + 1:], ' ') AS q
    FROM c, range(1, {longest}) js(j) WHERE j < k),
scores AS (SELECT cuts.lang, cuts.phrase, a, l.f AS l, r.f AS r, n, j, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
    FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = p JOIN f r ON r.lang = cuts.lang AND r.phrase = q JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_parts AS (SELECT c.lang, c.a, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM c, range(1, {longest}) starts(i), range(2, {longest}) sizes(m) WHERE m < k AND i + m - 1 <= k),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_parts p
    WHERE p.lang = b.lang AND p.phrase = b.phrase AND 100 * p.a >= {percent} * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= {top}"""
