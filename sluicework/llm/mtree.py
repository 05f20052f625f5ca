"""Exact top-k search by inner product with M-trees.

Vectors are whole numbers. One more coordinate gives all vectors of a tree the same norm, so that the largest inner product is
the smallest Euclidean distance and a metric tree applies. A tree is a set of pages: an inner page holds routing
objects with their covering radii and their distances to the page's own routing object, a leaf page holds vectors with
that distance. The search takes the page with the nearest bound first; a stored distance and the triangle inequality
rule most entries out before their own distance is computed.
"""

from __future__ import annotations

import heapq
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.common import stored

SCALE = 256
PAGE, FANOUT = 512, 16
TREE_ROWS = 4096  # vectors of a tree, about
MOST_REGIONS = 256
SAMPLE_ROWS = 2048  # bounded sample: routing objects of the regions, and a first bound for each query
QUERIES_AT_ONCE = 512
EXACT = 2.0**52
LONG = 2**63 - 1


def products(vectors: np.ndarray, query: np.ndarray, limit: float) -> np.ndarray:
    """Inner products as exact whole numbers; ``limit`` bounds their size. Beyond a long they are cut to its range."""
    if limit < EXACT:
        return (vectors @ query).astype(np.int64)
    if limit < 2.0**62:
        return vectors.astype(np.int64) @ query.astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(v, query, strict=True)) for v in vectors]
    return np.array([max(-LONG, min(LONG, x)) for x in exact], dtype=np.int64)


@dataclass
class Page:
    """Entries of a page: vectors with the extra coordinate, distances to the page's routing object, and for a leaf the
    ids, for an inner page the covering radii and the pages below."""

    vectors: np.ndarray
    parent: np.ndarray
    ids: np.ndarray | None = None
    radii: np.ndarray | None = None
    below: list[int] = field(default_factory=list)


@dataclass
class Tree:
    pages: list[Page]
    norm2: float  # that all vectors have with the extra coordinate
    centre: np.ndarray
    radius: float
    limit: float  # of the absolute value of a coordinate


def _distances(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - centre) ** 2).sum(axis=1))


def build(ids: np.ndarray, vectors: np.ndarray) -> Tree:
    """Bulk load: spread routing objects, assign each vector to the nearest, and so on below until a page holds all."""
    norms = (vectors**2).sum(axis=1)
    norm2 = float(norms.max(initial=0))
    whole = np.concatenate([vectors, np.sqrt(norm2 - norms)[:, None]], axis=1)
    pages: list[Page] = []

    def load(rows: np.ndarray, centre: np.ndarray) -> int:
        if len(rows) <= PAGE:
            pages.append(Page(whole[rows], _distances(whole[rows], centre), ids=ids[rows]))
            return len(pages) - 1
        chosen = [0]
        nearest = _distances(whole[rows], whole[rows[0]])
        while len(chosen) < FANOUT and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _distances(whole[rows], whole[rows[chosen[-1]]]))
        objects = whole[rows[chosen]]
        # Vectors that are all the same, or one far group, are cut by number.
        to = np.stack([_distances(whole[rows], o) for o in objects]).argmin(axis=0)
        parts = [rows[to == k] for k in range(len(objects))]
        if max(map(len, parts)) > len(rows) * 0.9:
            parts = np.array_split(rows, FANOUT)
            objects = np.stack([whole[p[0]] for p in parts])
        radii = np.array([_distances(whole[p], o).max() for p, o in zip(parts, objects, strict=True)])
        below = [load(p, o) for p, o in zip(parts, objects, strict=True)]
        pages.append(Page(objects, _distances(objects, centre), radii=radii, below=below))
        return len(pages) - 1

    centre = whole[0] if len(whole) else np.zeros(vectors.shape[1] + 1)
    load(np.arange(len(ids)), centre)
    radius = float(_distances(whole, centre).max(initial=0))
    return Tree(pages, norm2, centre, radius, float(np.abs(vectors).max(initial=0)))


def search(tree: Tree, query_id: int, query: np.ndarray, k: int, floor: float) -> list[tuple[int, int]]:
    """Up to ``k`` (score, id), best first, ties to smaller ids; ``floor``: scores below it are not wanted.

    Vectors with the query's own id are passed over.
    """
    square, limit = float(query @ query), float(np.abs(query).max(initial=0)) * tree.limit * max(len(query), 1)
    longer = np.append(query, 0.0)
    slack = 1e-9 * (square + tree.norm2 + 1)

    def distance(score: float) -> float:
        return float(np.sqrt(max(0.0, square + tree.norm2 - 2 * score + slack)))

    reach = distance(floor) if floor > -np.inf else np.inf
    best: list[tuple[int, int]] = []  # (-score, id), sorted
    own = float(np.sqrt(((tree.centre - longer) ** 2).sum()))
    heap = [(max(0.0, own - tree.radius), len(tree.pages) - 1, own)]
    while heap:
        bound, number, to_parent = heapq.heappop(heap)
        if bound > reach:
            break
        page = tree.pages[number]
        gap = np.abs(page.parent - to_parent)
        if page.ids is None:
            rows = np.flatnonzero(gap - page.radii <= reach + 1e-6)
            far = np.sqrt(np.maximum(((page.vectors[rows] - longer) ** 2).sum(axis=1), 0))
            for r, d in zip(rows.tolist(), far.tolist(), strict=True):
                nearest = max(0.0, d - float(page.radii[r]) - 1e-6)
                if nearest <= reach:
                    heapq.heappush(heap, (nearest, page.below[r], d))
            continue
        rows = np.flatnonzero((gap <= reach + 1e-6) & (page.ids != query_id))
        if not len(rows):
            continue
        scores = products(page.vectors[rows, :-1], query, limit)
        # Of a page, only its own k best (and ties) that also reach the k-th so far can count.
        least = max(floor, -best[-1][0] if len(best) == k else -np.inf, np.partition(scores, -k)[-k] if len(scores) > k else -np.inf)
        kept = np.flatnonzero(scores >= least)
        if not len(kept):
            continue
        rows, scores = rows[kept], scores[kept]
        best = sorted([*best, *zip((-scores).tolist(), page.ids[rows].tolist(), strict=True)])[:k]
        if len(best) == k:
            reach = min(reach, distance(-best[-1][0]))
    return [(-s, i) for s, i in best]


# --- Spark ------------------------------------------------------------------------------------------------------------


def whole_numbers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(vec_id, v)``: components times 256, rounded down; distinct. Rows without an id, and vectors that are null or
    hold a component that is null or not finite, are left out."""
    x = F.col("x")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    good = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    rows = rows.filter("vec_id IS NOT NULL AND x IS NOT NULL").filter(good)
    return rows.select("vec_id", F.transform(x, lambda e: F.floor(e * SCALE).cast("long")).alias("v")).distinct()


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """Vectors as rows; shorter ones count as filled up with zeros."""
    out = np.zeros((len(column), size))
    for row, v in zip(out, column.to_pylist(), strict=True):
        row[: len(v)] = v
    return out


def _region(sample: np.ndarray, regions: int) -> np.ndarray:
    """Routing objects of the regions: each the farthest in the sample from those before."""
    chosen, nearest = [0], _distances(sample, sample[0])
    while len(chosen) < regions and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(sample, sample[chosen[-1]]))
    return sample[chosen]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each vector with ``is_query`` (a condition on ``vec_id``), the ``k`` others
    with the largest inner product, fewer if there are fewer; ties go to the smaller id.

    Vectors are made whole numbers first (``whole_numbers``). Of equal vectors only the ``k + 1`` with the smallest ids
    can be among the results, so only these are indexed; the others are dropped before the shuffle. Regions hold trees
    of a bounded size, however many vectors a region has. Each query starts from the k-th best score in a bounded
    sample, and goes only to the trees that can do better. Repeated rows count once; shorter vectors are filled up with zeros;
    empty tables give no rows. Other columns are ignored. Where queries are a fixed share of all vectors the work grows with
    their product, less what the bounds save: much in few dimensions, little in many.
    """
    spark = vectors.sparkSession
    every = stored(whole_numbers(vectors, key, vector), "vectors")
    size = every.agg(F.max(F.size("v"))).first()[0]
    out = "query_id long, same long, vec_id long, score long"
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    size = max(size, 1)
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = stored(every.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place"), "candidates")
    sample = kept.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE_ROWS).collect()
    sample_ids, sample_v = np.array([r.vec_id for r in sample]), np.zeros((len(sample), size))
    for row, r in zip(sample_v, sample, strict=True):
        row[: len(r.v)] = r.v
    count = kept.count()
    centres = _region(sample_v, min(MOST_REGIONS, count // TREE_ROWS + 1))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), size)
            to = np.stack([_distances(v, c) for c in centres]).argmin(axis=0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to, pa.int64())], names=["vec_id", "v", "region"])

    placed = stored(kept.mapInArrow(assign, "vec_id long, v array<long>, region long"), "regions")
    sizes = {r.region: r["count"] for r in placed.groupBy("region").count().collect()}
    trees_of = F.create_map(*(F.lit(x) for r, n in sizes.items() for x in (r, n // TREE_ROWS + 1)))
    tree = F.col("region") * (1 << 32) + F.pmod(F.xxhash64("vec_id", "v"), F.col("trees"))
    placed = placed.withColumn("trees", trees_of[F.col("region")]).select(tree.alias("tree"), "vec_id", "v")

    def plant(rows: pa.Table) -> pa.Table:
        made = build(np.array(rows.column("vec_id").to_pylist()), _matrix(rows.column("v"), size))
        outline = pickle.dumps((made.centre, made.radius, made.norm2))
        return pa.table({"tree": [rows.column("tree")[0].as_py()], "outline": [outline], "pages": [pickle.dumps(made)]})

    forest = stored(placed.groupBy("tree").applyInArrow(plant, "tree long, outline binary, pages binary"), "forest")
    asked = every.filter(is_query)
    blocks = asked.count() // QUERIES_AT_ONCE + 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))

    def pack(rows: pa.Table) -> pa.Table:
        """A block of queries, each with the k-th best score in the sample."""
        ids, v = np.array(rows.column("vec_id").to_pylist()), _matrix(rows.column("v"), size)
        limit = float(np.abs(v).max(initial=0)) * float(np.abs(sample_v).max(initial=0)) * size
        floors = np.full(len(ids), -np.inf)
        for n, (i, q) in enumerate(zip(ids, v, strict=True)):
            scores = products(sample_v[sample_ids != i], q, limit)
            if len(scores) >= k:
                floors[n] = float(np.sort(scores)[-k])
        return pa.table({"queries": [pickle.dumps((ids, v, floors))]})

    packed = stored(asked.groupBy("block").applyInArrow(pack, "queries binary"), "queries")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The queries of a block that a tree can give something to."""
        for batch in batches:
            for row in batch.to_pylist():
                (centre, radius, norm2), (ids, v, floors) = pickle.loads(row["outline"]), pickle.loads(row["queries"])
                squares = (v**2).sum(axis=1)
                far = np.sqrt(((v - centre[:-1]) ** 2).sum(axis=1) + centre[-1] ** 2)
                slack = 1e-9 * (squares + norm2 + 1)
                reach = np.sqrt(np.maximum(squares + norm2 - 2 * floors + slack, 0))
                rows = far - radius <= reach + 1e-6
                if rows.any():
                    some = pickle.dumps((ids[rows], v[rows], floors[rows]))
                    yield pa.RecordBatch.from_arrays([pa.array([row["tree"]]), pa.array([some], pa.binary())], names=["tree", "queries"])

    # The stated queries against all trees, block by block: only outlines meet blocks here.
    routed = forest.select("tree", "outline").crossJoin(packed).mapInArrow(route, "tree long, queries binary")

    def visit(pages: pa.Table, queries: pa.Table) -> pa.Table:
        rows = []
        if pages.num_rows:
            made = pickle.loads(pages.column("pages")[0].as_py())
            for blob in queries.column("queries").to_pylist():
                for i, q, floor in zip(*pickle.loads(blob), strict=True):
                    same = zlib.crc32(q.tobytes())  # tells apart queries that share an id
                    rows.extend((int(i), same, found, score) for score, found in search(made, int(i), q, k, float(floor)))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        names = ["query_id", "same", "vec_id", "score"]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    found = forest.select("tree", "pages").groupBy("tree").cogroup(routed.groupBy("tree")).applyInArrow(visit, out)
    order = Window.partitionBy("query_id", "same").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
