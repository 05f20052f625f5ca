"""Importance resampling towards a target distribution.

Texts are bags of hashed n-grams. A bucket's gain is the logarithm of how much more of the target's n-grams than of the
corpus's fall into it; a document's weight is the mean gain of its n-grams. Adding Gumbel noise to the weights and taking the
highest sums draws documents without replacement in proportion to the exponentials of their weights.

Within a task the n-grams of a batch are interned in an open-addressed table of numpy arrays: xxHash64 picks the slot, the
bytes decide whether a slot is the right one, and a slot holds the bucket and the number of occurrences. Occurrences keep
their slot, so buckets are worked out once for each different n-gram and gains are gathered by slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.common import WORD_SQL, plain_bytes, stored, word_chunks

# Occurrences interned at once: some 30 MB as Python bytes and arrays.
GRAMS_AT_ONCE = 200_000


class Slots:
    """The different n-grams of a list of occurrences.

    ``slot_of`` has the slot of each occurrence; ``bucket`` and ``count`` are by slot, with a count of 0 where a slot is empty.
    """

    def __init__(self, grams: list[bytes], buckets: int) -> None:
        size = 1 << max(4, (2 * len(grams)).bit_length())
        words = np.empty(len(grams), dtype=object)
        words[:] = grams
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams), dtype=np.uint64, count=len(grams))
        keys, first = np.zeros(size, dtype=np.uint64), np.full(size, -1, dtype=np.int64)
        self.slot_of = np.zeros(len(grams), dtype=np.int64)
        todo, at = np.arange(len(grams)), (hashes & np.uint64(size - 1)).astype(np.int64)
        while len(todo):
            # Of several that meet an empty slot one takes it; the others look at it as at any taken one.
            free = first[at] < 0
            first[at[free]] = todo[free]
            keys[at[free]] = hashes[first[at[free]]]
            same = keys[at] == hashes[todo]
            same[same] = words[first[at[same]]] == words[todo[same]]
            self.slot_of[todo[same]] = at[same]
            todo, at = todo[~same], (at[~same] + 1) & (size - 1)
        self.count = np.bincount(self.slot_of, minlength=size)
        self.bucket = np.zeros(size, dtype=np.int64)
        used = np.flatnonzero(first >= 0)
        self.bucket[used] = [zlib.crc32(grams[i]) % buckets for i in first[used].tolist()]


def _grams(plain: bytes, least: int, most: int) -> Iterator[tuple[list[bytes], int]]:
    """The n-grams of ``least`` to ``most`` words of a text, with the number of words that each list brings."""
    before: list[bytes] = []
    for words in word_chunks(plain):
        run, grams = before + words, []
        for n in range(least, most + 1):
            # Those that end in the new words.
            from_ = max(0, len(before) - n + 1)
            grams += words if n == 1 else [b" ".join(run[i : i + n]) for i in range(from_, len(run) - n + 1)]
        yield grams, len(words)
        before = run[-(most - 1) :] if most > 1 else []


def _packs(texts: pa.Array, least: int, most: int) -> Iterator[tuple[list[bytes], list[int], list[int], list[int]]]:
    """N-grams of texts in a row, some ``GRAMS_AT_ONCE`` at a time: them, the rows they belong to, how many each brings, and words."""
    grams: list[bytes] = []
    rows: list[int] = []
    sizes: list[int] = []
    words: list[int] = []
    for row, text in enumerate(texts):
        for part, n in _grams(plain_bytes(text.as_py() or ""), least, most):
            grams += part
            rows.append(row)
            sizes.append(len(part))
            words.append(n)
            if len(grams) >= GRAMS_AT_ONCE:
                yield grams, rows, sizes, words
                grams, rows, sizes, words = [], [], [], []
    yield grams, rows, sizes, words


def bucket_counts(docs: DataFrame, buckets: int = 10_000, least: int = 1, most: int = 1, text: str = "text") -> np.ndarray:
    """How many n-grams of all texts fall into each bucket. Only these ``buckets`` sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for grams, *_ in _packs(batch.column("text"), least, most):
                slots = Slots(grams, buckets)
                used = np.flatnonzero(slots.count)
                np.add.at(sums, slots.bucket[used], slots.count[used])
        full = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(sums[full], pa.int64())], names=["bucket", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    sums = np.zeros(buckets, dtype=np.int64)
    for bucket, n in found.collect():
        sums[bucket] = n
    return sums


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1) (S + B) / ((s + 1) (T + B)))) of each of B buckets, for counts s of S and t of T."""
    size, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([floor(1000 * log((t + 1) * (all_s + size) / ((s + 1) * (all_t + size)))) for s, t in pairs], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, least: int = 1, most: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row: the floored mean gain of its n-grams, 0 without any."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, counts, n_words = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for grams, rows, sizes, words in _packs(batch.column("text"), least, most):
                slots = Slots(grams, buckets)
                running = np.concatenate([[0], np.cumsum(gain[slots.bucket[slots.slot_of]])])
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                np.add.at(sums, rows, np.diff(running[ends]))
                np.add.at(counts, rows, sizes)
                np.add.at(n_words, rows, words)
            found = [n_words, counts, np.where(counts > 0, sums // np.maximum(counts, 1), 0)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, found)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths that depends on the key and the seed only; null counts as an empty key."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    number = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((number + 0.5) / float(1 << 32)))).cast("long")


def _ranges(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` dealt to ranges of the given order, with the number of the range as ``part``."""
    return stored(rows.repartitionByRange(*order).select("*", F.spark_partition_id().alias("part")), "ranges")


def _placed(ranges: DataFrame, order: list[Column]) -> DataFrame:
    """``place``, from 1 in the given order: numbered within each range, after the sizes of the ranges before it."""
    # One row a range, of which there are as many as the shuffle has partitions.
    sizes = ranges.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranges.join(F.broadcast(sizes), "part").withColumn("place", F.col("before") + inside)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    buckets: int = 10_000,
    least: int = 1,
    most: int = 1,
    seed: int = 2024,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs``; the drawn ones have a rank.

    Of the rows with ``least_words`` words or more, ``percent`` per cent (rounded down) are drawn: those with the highest
    ``score``, the weight plus the noise of the key, ties to the smaller key. Null and empty texts have no features and weight 0. A row
    without a key has the noise of an empty one and comes last among equals; rows with one key have one noise, and
    repeated rows come out as often as they come in. An empty table gives an empty one; an empty target leaves all
    its counts at 0. Other columns are ignored. No row goes to the driver and no task holds more than a range of the order.
    """
    gain = gains(bucket_counts(docs, buckets, least, most, text), bucket_counts(target, buckets, least, most, "text"))
    rows = weights(docs, gain, least, most, text, key)
    rows = rows.select("*", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), (F.col("n_words") >= least_words).alias("fit"))
    # Finding the ranges reads the rows once more than dealing them.
    rows = stored(rows, "weights")
    order = [F.desc("fit"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranges = _ranges(rows, order)
    drawn = ranges.filter("fit").count() * percent // 100
    ranked = _placed(ranges, order)
    rank = F.when(F.col("fit") & (F.col("place") <= drawn), F.col("place"))
    return ranked.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))


def sql_twin(percent: int = 10, least_words: int = 20, buckets: int = 10_000, seed: int = 2024) -> str:
    """DuckDB text of the same result for single words, CRC-32 included."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH bits AS (SELECT [list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) FOR i IN range(256)] AS t),
docs AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({lower}, '{WORD_SQL}') AS w FROM documents),
corpus AS (SELECT k, unnest(w) AS word FROM docs),
target AS (SELECT unnest(regexp_extract_all({lower}, '{WORD_SQL}')) AS word FROM benchmark),
names AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM corpus UNION SELECT word FROM target)),
hashed AS (SELECT word, xor(list_reduce([4294967295::BIGINT] || [('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(length(h) // 2)],
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % {buckets} AS bucket FROM names, bits),
s AS (SELECT bucket, count(*) AS s FROM corpus JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target JOIN hashed USING (word) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT count(*) FROM corpus) + {buckets}))::DOUBLE
    / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM target) + {buckets}))::DOUBLE)) AS gain
    FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
sums AS (SELECT k, floor(sum(gain) / count(*))::BIGINT AS weight FROM corpus JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY k),
scores AS (SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score,
    len(w) >= {least_words} AS fit FROM docs LEFT JOIN sums USING (k)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id, n_features, weight) AS place,
    count(*) FILTER (WHERE fit) OVER () AS n FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= {percent} * n // 100 THEN place END AS rank FROM ranked"""
