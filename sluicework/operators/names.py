"""Names of a table found in texts: one pass over a text, at a cost that does not depend on how many names there are.

The column functions of ``functions.text`` carry their names as constants of the plan, which suits some hundreds. Here the names
are a table. A text gives the strings that a name could be, and an equality join finds those that are one: runs of a text's words
for terms, the ends of what stands before a province for cities. The names are counted: up to ``SMALL_NAMES`` they are sent to
every task, more are met by a shuffle. The texts' strings, of which Spark's statistics know too little, are never sent. What decides among the names of a text is looked at only where
one was found.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework import lookups
from sluicework.functions.lookup import let
from sluicework.functions.text import province_alone

# Where words begin and end; between two of these places stands a word, or what is between words. The ends of a text count
# only where a word stands there, so a text stands between two characters that are in no word and no name.
EDGE = r"(?U)\b"
_OUTSIDE = "\uffff"


# Names up to this many are sent to every task: some 15 MB.
SMALL_NAMES = 100_000


def _sized(names: DataFrame) -> tuple[list[int], DataFrame]:
    """The different sizes of the names, and the names marked for how a join meets them."""
    counts = {r["size"]: r["n"] for r in names.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(counts), F.broadcast(names) if sum(counts.values()) <= SMALL_NAMES else names.hint("merge")


def _pieces(low: Column) -> Column:
    return F.split(low, EDGE, -1)


def numbered(names: DataFrame, column: str, order: str) -> DataFrame:
    """Each lower-case name once, with its first place in the table's order."""
    return names.groupBy(F.lower(column).alias("name")).agg(F.min(order).alias("order"))


def extract_terms(rows: DataFrame, terms: DataFrame, key: str, text: str, term: str = "term", order: str = "order") -> DataFrame:
    """``(key, tags)``: the sorted different terms of each text, for every row of ``rows``; an empty array without any.

    The terms are those that one scan with the alternation of all terms between word boundaries would give: from left to
    right, of those that begin at one place the first in the table, none within another. ``key`` is unique in ``rows``.
    Only lengths of terms, in words and gaps, are collected: as many as the longest term has at most.
    """
    names = numbered(terms, term, order).filter("name <> ''").withColumn("size", F.size(F.filter(_pieces(F.col("name")), lambda p: p != "")))
    sizes, names = _sized(names)
    if not sizes:
        return rows.select(key, F.array().cast("array<string>").alias("tags"))
    pieces = rows.select(F.col(key).alias("_key"), _pieces(F.concat(F.lit(_OUTSIDE), F.lower(F.col(text)), F.lit(_OUTSIDE))).alias("_pieces"))
    # Each piece with those after it, as many as a name has: a row that held the text's whole array would be copied for each piece.
    nexts = F.arrays_zip(*(F.slice("_pieces", i + 1, F.greatest(F.size("_pieces") - i, F.lit(0))) for i in range(sizes[-1])))
    starts = pieces.select("_key", F.posexplode_outer(nexts).alias("at", "from")).filter("from.`0` <> ''")
    run = {n: F.concat_ws("", *(F.col(f"from.`{i}`") for i in range(n))) for n in sizes}
    runs = F.array(*(F.struct(F.lit(n).alias("size"), run[n].alias("name")) for n in sizes))
    runs = starts.select("_key", "at", F.inline(runs))
    hits = runs.join(names, ["name", "size"]).groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("at", "order", "size", "name"))).alias("hits"))

    def step(state: Column, hit: Column) -> Column:
        after = hit["at"] >= state["end"]
        end = F.when(after, hit["at"] + hit["size"]).otherwise(state["end"])
        kept = F.when(after, F.array_append(state["kept"], hit["name"])).otherwise(state["kept"])
        return F.struct(end.alias("end"), kept.alias("kept"))

    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("kept"))
    tags = F.array_sort(F.array_distinct(F.aggregate("hits", start, step, lambda s: s["kept"])))
    found = hits.select("_key", tags.alias("tags"))
    return rows.select(key).join(found, F.col(key) == F.col("_key"), "left").select(key, F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))


def _ends_of(words: Sequence[str]) -> str:
    """Pattern of the places where a word of the text ends with one of ``words``.

    The last character is tested first. A test for words of one length looks at one place, a test for words of all lengths at
    as many as there are lengths, for each word at each character.
    """
    by_size: dict[int, list[str]] = {}
    for word in sorted(set(words)):
        by_size.setdefault(len(word), []).append(re.escape(word))
    last = "".join(re.escape(c) for c in sorted({w[-1] for w in words}))
    return rf"(?U)(?<=[{last}])\b(?:{'|'.join(f'(?<=(?:{chr(124).join(same)}))' for same in by_size.values())})"


# What stands before a province's end is looked at so far back: the longest name with what may follow it.
REACH = 240


def locate(
    rows: DataFrame,
    cities: DataFrame,
    key: str,
    text: str,
    codes: Mapping[str, str] = lookups.PROVINCE_CODES,
) -> DataFrame:
    """``(key, city, province)`` for every row of ``rows``: "City, Province" in a text, else a code standing alone.

    ``cities`` has ``name`` (lower case), ``city`` (as shown), ``province`` and ``order``. Among all cities followed by their
    province's name or by any code the longest name wins, then the table's order. ``key`` is unique in ``rows``, and
    white space in the texts is collapsed; names have up to 150 characters.

    Texts are cut where a word ends with a province's name or code, which are few; the ends of what stands before, as long as names
    are, are looked up among the names. Only lengths of names are collected, 150 at most.
    """
    names = cities.select("name", "city", "province", "order").withColumn("size", F.length("name")).filter("size BETWEEN 1 AND 150")
    sizes, names = _sized(names)
    endings = [(c.lower(), None) for c in codes] + [(p.lower(), p) for p in sorted(set(codes.values()))]

    def befores(parts: Column) -> Column:
        """What stands before each cut, as far as it is looked at. A part has two characters at least."""
        first = lambda n: F.greatest(F.lit(1), n - REACH // 2 + 1)
        before = lambda n: F.right(F.array_join(F.slice(parts, first(n), n - first(n) + 1), ""), F.lit(REACH))
        return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), before))

    cut = F.split(F.lower(F.col(text)), _ends_of([w for w, _ in endings]), -1)
    cuts = rows.select(F.col(key).alias("_key"), F.explode_outer(let(cut, befores)).alias("before")).filter("before IS NOT NULL")
    ends = F.array(*(F.struct(F.lit(w).alias("word"), F.lit(p).cast("string").alias("only")) for w, p in endings))
    cuts = cuts.select("_key", "before", F.inline(F.filter(ends, lambda e: F.endswith(F.col("before"), e["word"]))))
    before = F.regexp_replace(F.substring("before", F.lit(1), F.length("before") - F.length("word")), r"(?U),?\s*\z", "")
    cuts = cuts.select("_key", "only", before.alias("before"))
    tails = F.array(*(F.when(F.length("before") >= n, F.right("before", F.lit(n))) for n in sizes))
    tails = cuts.select("_key", "only", F.explode(tails if sizes else F.array().cast("array<string>")).alias("name")).filter("name IS NOT NULL")
    met = tails.join(names, "name").filter("only IS NULL OR only = province")
    best = met.groupBy("_key").agg(F.max(F.struct("size", (-F.col("order")).alias("order"), "city", "province")).alias("best"))
    alone = province_alone(F.col(text), codes)
    found = rows.select(key, alone.alias("_alone")).join(best, F.col(key) == F.col("_key"), "left")
    return found.select(key, F.col("best.city").alias("city"), F.coalesce("best.province", "_alone").alias("province"))
