"""License scans: phrases word by word, and an exact similarity join of text blocks with license templates.

A block (a line with the one after it, as notices wrap) meets a template when it contains a given share of the template's
different words. Words are put into one global order, rare ones first. Of two sorted sets with at least ``a`` words in common,
the first common word stands within the first ``size - a + 1`` words of both (prefix filter), both have ``a`` words (length
filter), and enough words are left behind it on both sides (positional filter). Pairs that pass are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.common import WORD_SQL, plain_bytes, small_batches, stored, texts_of, word_chunks

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices as their licenses ask for them or as they are commonly given, with the label of each.
TEMPLATES = (
    ("apache", "Licensed under the Apache License"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Licensed under the BSD License"),
    ("cc", "licensed under a Creative Commons Attribution License"),
    ("cc-by-nc", "Licensed under CC BY-NC"),
    ("cc-by-sa", "Licensed under CC BY-SA"),
    ("cc0", "waived all copyright and related or neighboring rights to this work"),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl", "subject to the terms of the Mozilla Public License"),
)
# Share of a template's different words that a block must contain: all of up to nine words.
SHARE = Fraction(9, 10)


class Template(NamedTuple):
    """A template's different words as ranks in the global order, rarest first, and how many of them a block needs."""

    number: int
    label: str
    ranks: list[int]
    needed: int


def _words(text: str) -> list[bytes]:
    return plain_bytes(text).split()


def _places(plain: bytes, phrases: list[list[bytes]]) -> tuple[int, list[tuple[int, int]]]:
    """Number of words, and ``(start, phrase)`` wherever a phrase's words stand in a row, counted in words."""
    longest = max(map(len, phrases), default=1)
    needles = [b" " + b" ".join(p) + b" " for p in phrases]
    done, before, found = 0, [], []
    for words in word_chunks(plain):
        run = before + words
        joined = b" " + b" ".join(run) + b" "
        for k, needle in enumerate(needles):
            at, word, last = joined.find(needle), 0, 0
            while at >= 0:
                word, last = word + joined.count(b" ", last, at), at
                # What ends in the words before was found with them.
                if word + len(phrases[k]) > len(before):
                    found.append((done - len(before) + word, k))
                at = joined.find(needle, at + 1)
        done += len(words)
        before = run[-(longest - 1) :] if longest > 1 else []
    return done, sorted(found)


def _blocks(plain: bytes, known: dict[bytes, int], least: int) -> Iterator[tuple[int, set[int]]]:
    """The blocks of a text with at least ``least`` words of templates: number of the first line, and these words' ranks."""
    names, before, line = known.keys(), set(), -1
    for line, content in enumerate(plain.split(b"\n")):
        now = {known[w] for words in word_chunks(content) for w in names & set(words)}
        if line and len(before | now) >= least:
            yield line - 1, before | now
        before = now
    if len(before) >= least:
        yield line, before


def word_frequencies(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict[bytes, int]:
    """How many blocks of all texts contain each word of the vocabulary. Only these sums reach the driver."""
    names = sorted(vocabulary)
    numbers = {w: i for i, w in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * len(names)
        for batch in batches:
            for part in small_batches([batch]):
                for t in texts_of(part):
                    for _, found in _blocks(plain_bytes(t), numbers, 1):
                        for i in found:
                            sums[i] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(len(names)), pa.int32()), pa.array(sums, pa.int64())], names=["word", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n")).collect()
    return {w: 0 for w in names} | {names[i]: n for i, n in found}


def ordered(templates: tuple[tuple[str, str], ...], frequencies: dict[bytes, int], share: Fraction) -> tuple[dict[bytes, int], list[Template]]:
    """The global order of words (rare ones first, equally frequent ones by their bytes), and the templates in it."""
    ranks = {w: i for i, w in enumerate(sorted(frequencies, key=lambda w: (frequencies[w], w)))}
    sets = [sorted({ranks[w] for w in _words(t)}) for _, t in templates]
    return ranks, [Template(k, templates[k][0], s, ceil(share * len(s))) for k, s in enumerate(sets) if s]


def _read(docs: DataFrame, phrases: dict[str, str], ranks: dict[bytes, int], least: int, text: str, key: str) -> DataFrame:
    """One row a document: its number of words, the places of phrases, and the blocks that are long enough to meet a template."""
    listed = [_words(p) for p in phrases]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            counts, places, blocks = [], [], []
            for t in texts_of(batch):
                plain = plain_bytes(t)
                n, found = _places(plain, listed)
                counts.append(n)
                places.append([{"start": s, "phrase": k} for s, k in found])
                blocks.append([{"line": i, "words": sorted(x)} for i, x in _blocks(plain, ranks, least)] if ranks else [])
            arrays = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(places, PLACES), pa.array(blocks, BLOCKS)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "places", "blocks"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_words long, places array<struct<start: long, phrase: int>>, blocks array<struct<line: long, words: array<int>>>"
    return rows.mapInArrow(run, schema)


PLACES = pa.list_(pa.struct([("start", pa.int64()), ("phrase", pa.int32())]))
BLOCKS = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.list_(pa.int32()))]))


def candidates(blocks: DataFrame, templates: list[Template]) -> DataFrame:
    """Pairs ``(row, line, template)`` of ``blocks`` (``row``, ``line``, ``words``) and templates that pass the three filters."""
    spark, least = blocks.sparkSession, min(t.needed for t in templates)
    prefixes = [(w, t.number, i, len(t.ranks), t.needed) for t in templates for i, w in enumerate(t.ranks[: len(t.ranks) - t.needed + 1])]
    # As many rows as the templates have words.
    index = F.broadcast(spark.createDataFrame(prefixes, "word int, template int, i int, size int, needed int"))
    count = F.size("words")
    probes = blocks.select("row", "line", count.alias("n"), F.posexplode(F.slice("words", F.lit(1), count - least + 1)).alias("j", "word"))
    met = probes.join(index, "word").filter("n >= needed AND j <= n - needed AND 1 + least(size - i - 1, n - j - 1) >= needed")
    return met.select("row", "line", "template").distinct()


def matches(blocks: DataFrame, templates: list[Template]) -> DataFrame:
    """``(row, line, label, share)`` of all blocks that contain enough words of a template."""
    kinds = "template int, label string, ranks array<int>, needed int"
    listed = F.broadcast(blocks.sparkSession.createDataFrame([(t.number, t.label, t.ranks, t.needed) for t in templates], kinds))
    met = candidates(blocks, templates).join(blocks.select("row", "line", "words"), ["row", "line"]).join(listed, "template")
    common = F.size(F.array_intersect("words", "ranks"))
    met = met.select("row", "line", "label", "needed", common.alias("common"), (common / F.size("ranks")).alias("share"))
    return met.filter("common >= needed").select("row", "line", "label", "share")


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    share: Fraction = SHARE,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``(doc_id, n_words, places, found)`` for every row of ``docs``.

    ``places`` are structs of ``start`` and ``phrase``: where the words of a phrase stand in a row, counted in words from
    0, with the phrase's number in ``phrases``. ``found`` are structs of ``line``, ``label`` and ``share``: blocks with at
    least ``share`` of the different words of a template. Null and empty texts have neither; a block of a very long line has
    all its words. Repeated rows come out as often as they come in; an empty table gives an empty one. Other columns are
    ignored. Templates are a parameter that is broadcast; nothing else is.
    """
    spark = docs.sparkSession
    vocabulary = {w for _, t in templates for w in _words(t)}
    ranks, listed = ordered(templates, word_frequencies(docs, vocabulary, text) if vocabulary else {}, share)
    least = min((t.needed for t in listed), default=1)
    rows = stored(_read(docs, phrases, ranks, least, text, key).withColumn("row", F.monotonically_increasing_id()), "blocks")
    found = F.array().cast("array<struct<line: long, label: string, share: double>>")
    if not listed:
        return rows.select("doc_id", "n_words", "places", found.alias("found"))
    blocks = rows.select("row", F.inline("blocks"))
    hits = matches(blocks, listed).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("line", "label", "share"))).alias("hits"))
    return rows.join(hits, "row", "left").select("doc_id", "n_words", "places", F.coalesce("hits", found).alias("found"))


def digest(scanned: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of scanned rows.

    ``score`` is 1 where a phrase stands, else the highest share of a template, 0 without any.
    """
    names = F.array(*map(F.lit, phrases.values()))
    base = F.array_distinct(F.transform("places", lambda p: F.get(names, p["phrase"])))
    both = F.array_union(base, F.transform("found", lambda f: f["label"]))
    best = F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )


def sql_twin(phrases: dict[str, str] = PHRASES, templates: tuple[tuple[str, str], ...] = TEMPLATES, share: Fraction = SHARE) -> str:
    """DuckDB text of the digest: every block against every template, without filters."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def words(x: str) -> str:
        return f"regexp_extract_all(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD_SQL}')"

    listed = ", ".join(f"({quoted(label)}, {words(quoted(t))})" for label, t in templates)
    named = ", ".join(f"({quoted(label)}, {words(quoted(p))})" for p, label in phrases.items())
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, {words('t')} AS w FROM d),
templates(label, words) AS (VALUES {listed}),
phrases(label, p) AS (VALUES {named}),
places AS (SELECT k, label, i - 1 AS start FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM w), phrases
    WHERE w[i] = p[1] AND w[i:i + len(p) - 1] = p),
base AS (SELECT k, count(*) AS n, min(start) AS first_word, max(start) AS last_word,
    list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY k),
lines AS (SELECT k, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT k, string_split(t, chr(10)) AS l FROM d)),
blocks AS (SELECT k, list_distinct({words("l[i] || ' ' || coalesce(l[i + 1], '')")}) AS b FROM lines),
shares AS (SELECT k, label, len(list_intersect(b, words)) AS common, len(list_distinct(words)) AS size FROM blocks, templates),
found AS (SELECT k, label, common / size AS share FROM shares WHERE common * {share.denominator} >= size * {share.numerator}),
hits AS (SELECT k, list(DISTINCT label) AS labels, max(share) AS share FROM found GROUP BY k)
SELECT doc_id, len(w.w) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
    coalesce(array_to_string(base.labels, ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(hits.labels, [])))), ','), '') AS labels,
    CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d JOIN w USING (k) LEFT JOIN base USING (k) LEFT JOIN hits USING (k)"""
