"""SimHash near-duplicates: fingerprints, candidates by a generalised pigeonhole, exact links, components.

A fingerprint has 64 bits. Two fingerprints that differ in at most ``t`` bits agree, for any split of the bits into
``m`` partitions with thresholds that sum to ``t - m + 1``, up to the partition's threshold in one of the partitions.
Partitions hold bits that go together in this corpus; thresholds come from a dynamic programme over the number of
candidates that the corpus itself would give.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.common import small_batches, stored, texts_of
from sluicework.llm.components import connected_components

BITS = 64
# Halves of 32 bits: in narrower partitions, rows that agree by chance grow with the square of the corpus.
PARTITION_COUNTS = (2,)
# Shingles whose votes are summed at once: bounds the memory of a very long text.
VOTES_AT_ONCE = 1 << 16


def _fingerprint(text: str, words: int, seed: int) -> int:
    """SimHash of one text as an unsigned number; 0 for a text without words."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = iter([b" ".join(found)])
        count = 1
    else:
        shingles = map(b" ".join, zip(*(itertools.islice(found, i, None) for i in range(words)), strict=False))
        count = len(found) - words + 1
    votes = np.zeros(BITS, dtype=np.int64)
    hash_of = xxhash.xxh64_intdigest
    while part := [hash_of(s, seed) for s in itertools.islice(shingles, VOTES_AT_ONCE)]:
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, fp)`` for every row: ASCII letters in lower case, words between ASCII white space, shingles repeated
    as often as they occur, XXH64. ``fp`` holds the unsigned number's bits in a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            values = np.array([_fingerprint(t, words, seed) for t in texts_of(batch)], dtype=np.uint64)
            ids = batch.column("doc_id").cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits how many have both set. Only 4096 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, count = np.zeros((BITS, BITS)), 0
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("fp").to_numpy(zero_copy_only=False)).view(np.uint8)
            bits = np.unpackbits(raw.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            count += len(bits)
        if count:
            sums = np.append(both.ravel(), count).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["cell", "n"])

    sums = np.zeros(BITS * BITS + 1)
    for cell, n in fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        sums[cell] = n
    return int(sums[-1]), sums[:-1].reshape(BITS, BITS)


def group_bits(count: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Split the bits into ``parts`` groups of almost equal size, each grown by the bit most correlated with it."""
    ones = np.diag(both) / max(count, 1)
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-12))
    related = np.abs(both / max(count, 1) - np.outer(ones, ones)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        left = sorted(free)
        group = [max(left, key=lambda b: (related[b, left].max(), -b))]
        while len(group) < size:
            left = sorted(free - set(group))
            group.append(max(left, key=lambda b: (related[b, group].mean(), -b)))
        groups.append(sorted(group))
        free -= set(group)
    return groups


def _signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _collisions(fps: DataFrame, splits: dict[int, list[list[int]]]) -> dict[tuple[int, int], float]:
    """For each partition of each split, how many ordered pairs of fingerprints agree on it, counted over all."""
    names = [(m, p) for m, groups in splits.items() for p in range(len(groups))]
    masks = [_mask(splits[m][p]) for m, p in names]
    keys = F.array(*(F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(x)).alias("key")) for i, x in enumerate(masks)))
    sizes = fps.select(F.explode(keys).alias("k")).groupBy("k.i", "k.key").count()
    pairs = sizes.groupBy("i").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1)))
    return {names[i]: n for i, n in pairs.collect()}


def allocate(count: int, widths: list[int], agreeing: list[float], most: int) -> tuple[float, list[int]]:
    """Thresholds of the partitions that cost least, by dynamic programming; -1 leaves a partition out.

    A partition with threshold ``e`` is probed with all values within ``e`` bits, and is taken to give as many
    candidates for each of them as its own value does. A fingerprint with candidates costs its exact check once.
    """

    def cost(width: int, same: float, e: int) -> float:
        if e < 0:
            return 0.0
        probes = sum(comb(width, i) for i in range(e + 1))
        return count * probes + (BITS + 1) * min(float(count), same * probes)

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, same in zip(widths, agreeing, strict=True):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (paid, chosen) in best.items():
            for e in range(-1, min(most - used, width) + 1):
                total = paid + cost(width, same, e)
                if used + e + 1 not in step or total < step[used + e + 1][0]:
                    step[used + e + 1] = (total, [*chosen, e])
        best = step
    # Thresholds sum to most - m + 1, so the numbers e + 1 sum to most + 1.
    return best[most + 1]


def choose_partitions(fps: DataFrame, most: int) -> list[tuple[list[int], int]]:
    """Partitions of the bits with their thresholds, for distinct fingerprints ``fps``."""
    count, both = bit_counts(fps)
    splits = {m: group_bits(count, both, m) for m in PARTITION_COUNTS}
    agreeing = _collisions(fps, splits)
    plans = []
    for m, groups in splits.items():
        paid, chosen = allocate(count, [len(g) for g in groups], [agreeing.get((m, p), 0.0) for p in range(m)], most)
        plans.append((paid, m, [(g, e) for g, e in zip(groups, chosen, strict=True) if e >= 0]))
    return min(plans, key=lambda plan: plan[:2])[2]


def _flips(value: Column, bits: list[int], most: int) -> Column:
    """Array of the values that differ from ``value`` in 1 to ``most`` of the given bits."""
    changes = [_mask(list(c)) for e in range(1, most + 1) for c in itertools.combinations(bits, e)]
    return F.transform(F.array(*map(F.lit, changes)), lambda x: value.bitwiseXOR(x)) if changes else F.array().cast("array<long>")


def candidates(fps: DataFrame, partitions: list[tuple[list[int], int]]) -> DataFrame:
    """The rows of ``fps`` (``rep``, ``fp``) that have another one within the threshold of some partition.

    No pairs are made: a probed value counts when an indexed one stands behind it and at least one other row shares
    it. The counts are combined before the shuffle, and the join back can be split at a hot value.
    """
    rows = []
    for p, (bits, most) in enumerate(partitions):
        key = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
        base = fps.select("rep", "fp", F.lit(p).alias("p"), key.alias("own_key"))
        rows.append(base.select("rep", "fp", "p", F.col("own_key").alias("key"), F.lit(1).alias("own")))
        if most:
            probes = F.explode(_flips(F.col("own_key"), bits, most)).alias("key")
            rows.append(base.select("rep", "fp", "p", probes).withColumn("own", F.lit(0)))
    probed = rows[0]
    for more in rows[1:]:
        probed = probed.unionByName(more)
    met = probed.groupBy("p", "key").agg(F.sum("own").alias("indexed"), F.count("*").alias("n"))
    met = stored(met.filter("indexed > 0 AND n > 1").select("p", "key"), "probed")
    return probed.join(met, ["p", "key"], "left_semi").select("rep", "fp").distinct()


def links(found: DataFrame, most: int) -> DataFrame:
    """Edges ``(rep, low)`` that join exactly the fingerprints of ``found`` that differ in ``most`` bits or fewer.

    Two fingerprints differ in at most ``2 e`` bits just when some value lies within ``e`` bits of both, so each row
    visits the values around it and is tied to the smallest row that visits the same value. A value within ``e`` bits
    can only be shared by rows that are all within ``2 e`` of each other: for 2 bits that is at most 65 rows, whatever
    the size of a group of copies.
    """
    if most % 2:
        raise ValueError("the number of differing bits must be even")
    around = most // 2
    visits = found.select("rep", "fp", F.explode(F.concat(F.array("fp"), _flips(F.col("fp"), list(range(BITS)), around))).alias("mid"))
    low = F.min("rep").over(Window.partitionBy("mid"))
    return visits.select("rep", low.alias("low")).filter("rep > low").distinct()


def near_duplicates(docs: DataFrame, words: int = 3, most: int = 2, seed: int = 42, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Rows whose fingerprints differ in ``most`` bits or fewer are linked; ``component_id`` is the smallest ``doc_id``
    that can be reached over links. Null and empty texts, and texts without words, have the fingerprint 0 and are linked like any
    other. Repeated rows come out as often as they come in. A row without ``doc_id`` keeps its fingerprint and takes
    the component of the rows with an id that have the same one, else null. Other columns are ignored.
    Exact copies are one row per fingerprint before anything else happens. ``most`` must be even (see ``links``), else it
    is an error.
    """
    prints = stored(fingerprints(docs, words, seed, text, key), "fingerprints")
    distinct = stored(prints.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    found = stored(candidates(distinct, choose_partitions(distinct, most)), "candidates")
    roots = stored(connected_components(links(found, most), "rep", "low"), "roots")
    placed = distinct.join(roots, distinct.rep == roots.member, "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    placed = stored(placed, "placed")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(placed, "fp", "left").select("doc_id", shown, "component_id")
