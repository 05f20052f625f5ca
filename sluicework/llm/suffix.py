"""Removal of byte strings that also start in an earlier document, by suffix arrays over shards.

A string of ``LENGTH`` bytes is filed under its anchor: the gram in it with the smallest hash. Equal strings have the
same anchor at the same place, so all their copies meet in one shard, and a run of neighbouring strings with one anchor
travels as one segment. Only anchors that occur in more than one document send segments; equal segments of a chunk of
documents are sent once, with the smallest id. A shard joins its distinct segments to one text, builds its suffix array by
induced sorting, takes permuted common prefixes, and reads off the smallest id of each string; the answers go back to the
chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.llm.common import small_batches, texts_of
from sluicework.llm.sais import prefixes_reach, suffix_array, words_at

LENGTH = 50
GRAM = 16
WINDOW = LENGTH - GRAM + 1
CHUNK_BYTES = 4_000_000  # of texts handled at once: some 300 MB of memory
BLOCK = 1 << 15  # windows handled at once
PLACE = np.uint64(0xFFFFFFFF)
# Segments are written with UTF-8 bytes moved up by two, so that 1 can end a segment and 0 the text.
SHIFT, SEPARATOR, END = 2, 1, 0
ID = np.int64


@dataclass
class Chunk:
    """The documents of a chunk in the order of id and text, and the strings in them that have an anchor.

    ``first``, ``count`` and ``anchor`` describe runs of neighbouring strings with the same anchor: the place of the
    first string in ``data``, the number of strings, the hash of the anchor; ``doc`` is the document's number.
    """

    ids: list[int | None]
    texts: list[bytes]
    starts: np.ndarray
    data: np.ndarray
    first: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    doc: np.ndarray


def _mixed(words: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place on."""
    h = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
    other = words[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= other << np.uint64(31)
    # The shifted halves share no bit.
    h ^= np.right_shift(other, np.uint64(33), out=other)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _least(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash at each place, and for each window of places the one with the smallest hash: of equal ones, the leftmost.

    Windows are taken a block at a time, whose arrays stay in the processor's cache.
    """
    hashes = np.empty(len(data), dtype=np.uint64)
    place = np.empty(len(data) - WINDOW + 1, dtype=np.int64)
    # Grams that begin near the end of the data go on with zeros.
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    for start in range(0, len(place), BLOCK):
        end = min(start + BLOCK, len(place)) + WINDOW - 1
        own = _mixed(words_at(padded[start : end + 16])[:-8])
        hashes[start:end] = own
        # Upper half of the hash, with its place in the lower half.
        own &= ~PLACE
        own |= np.arange(start, end, dtype=np.uint64)
        span = 1
        while span * 2 <= WINDOW:
            own = np.minimum(own[:-span], own[span:])
            span *= 2
        if span < WINDOW:
            own = np.minimum(own[: len(own) - (WINDOW - span)], own[WINDOW - span :])
        place[start : start + len(own)] = own & PLACE
    return hashes, place


def chunk_of(rows: list[tuple[int | None, str | None]]) -> Chunk:
    """Read the documents of a chunk. Documents without an id take no part: they have no strings here."""
    named = sorted((i, (t or "").encode()) for i, t in rows if i is not None)
    ids: list[int | None] = [i for i, _ in named] + [None for i, _ in rows if i is None]
    texts = [t for _, t in named] + sorted((t or "").encode() for i, t in rows if i is None)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return Chunk(ids, texts, starts, data, none, none, none.astype(np.uint64), none)
    hashes, place = _least(data)
    # No string starts at the last places of a document, so runs of different documents never touch.
    for start, end in zip(starts[: len(named)].tolist(), starts[1:].tolist()):
        place[max(start, end - LENGTH + 1) : end] = -1
    place[starts[len(named)] :] = -1
    heads = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    count = np.diff(heads, append=len(place))
    anchors = place[heads]
    runs = anchors >= 0
    first = heads[runs]
    return Chunk(ids, texts, starts, data, first, count[runs], hashes[anchors[runs]], np.searchsorted(starts, first, "right") - 1)


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _rows_of(table: pa.Table, *columns: str) -> list[tuple]:
    return list(zip(*(table.column(c).to_pylist() for c in columns), strict=True))


def _sorted_anchors(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors of a chunk, and whether each occurs in documents with different ids."""
    order = np.argsort(chunk.anchor, kind="stable")
    sorted_anchors, docs = chunk.anchor[order], chunk.doc[order]
    heads = np.flatnonzero(np.concatenate([[True], sorted_anchors[1:] != sorted_anchors[:-1]])) if len(order) else order
    if not len(heads):
        return sorted_anchors, np.zeros(0, dtype=bool)
    ids = np.array([i or 0 for i in chunk.ids], dtype=ID)[docs]
    low, high = np.minimum.reduceat(ids, heads), np.maximum.reduceat(ids, heads)
    return sorted_anchors[heads], low != high


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its members, in order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def _segments(chunk: Chunk, wanted: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct segments of the runs marked in ``wanted``, in order of first sight; each marked run's segment; each
    segment's smallest id and anchor."""
    raw = chunk.data.tobytes()
    runs = np.flatnonzero(wanted)
    known: dict[bytes, int] = {}
    which = np.zeros(len(runs), dtype=np.int64)
    for k, (a, b) in enumerate(zip(chunk.first[runs].tolist(), (chunk.first[runs] + chunk.count[runs] + LENGTH - 1).tolist(), strict=True)):
        which[k] = known.setdefault(raw[a:b], len(known))
    # Documents stand in the order of their ids, so a segment's first run has the smallest one; written last, it stays.
    low = np.zeros(len(known), dtype=ID)
    low[which[::-1]] = np.array([i or 0 for i in chunk.ids], dtype=ID)[chunk.doc[runs]][::-1]
    anchor = np.zeros(len(known), dtype=np.uint64)
    anchor[which] = chunk.anchor[runs]
    return list(known), which, low, anchor


def answer(segments: list[bytes], low: np.ndarray) -> np.ndarray:
    """For distinct segments with the smallest id of each: the smallest id of every string that starts in them, in a row.

    The segments are joined to one text whose suffix array brings equal strings together.
    """
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    text = np.frombuffer(bytes([SEPARATOR - SHIFT + 256]).join(segments) + b"\0", dtype=np.uint8) + np.uint8(SHIFT)
    text[-1] = END
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    counts = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(segments)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    places = begins[owner] + inside
    number = np.full(len(text), -1, dtype=np.int64)
    number[places] = np.arange(len(places))
    order = suffix_array(text, 256)
    order = order[number[order] >= 0]
    heads = np.flatnonzero(~prefixes_reach(text, order, LENGTH))
    member = number[order]
    least = np.minimum.reduceat(low[owner[member]], heads)
    result = np.empty(len(places), dtype=ID)
    result[member] = np.repeat(least, np.diff(np.concatenate([heads, [len(order)]])))
    return result


def _packed(*arrays: np.ndarray) -> bytes:
    body = b"".join(np.array([a.nbytes], dtype="<i8").tobytes() + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        size = int(np.frombuffer(raw, "<i8", 1, at)[0])
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


BLOB = "bucket long, chunk long, blob binary"
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    kinds = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())])
    return pa.Table.from_pylist([dict(zip(("bucket", "chunk", "blob"), r, strict=True)) for r in rows], schema=kinds)


def _send_anchors(buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        anchors, several = _sorted_anchors(chunk_of(_rows_of(docs, "doc_id", "text")))
        number = docs.column("chunk")[0].as_py()
        rows = [(b, number, _packed((anchors[at] & PLACE).astype("<u4"), several[at])) for b, at in _by_bucket(_bucket(anchors, buckets))]
        return _blobs(rows)

    return run


def _find_repeated(blobs: pa.Table) -> pa.Table:
    """For each chunk, which of the anchors that it sent here occur in several documents."""
    sent = [(b, c, *_unpacked(x, "<u4", "?")) for b, c, x in _rows_of(blobs, "bucket", "chunk", "blob")]
    values, sizes = np.concatenate([a for _, _, a, _ in sent]), [len(a) for _, _, a, _ in sent]
    several = np.concatenate([s for *_, s in sent])
    _, back, times = np.unique(values, return_inverse=True, return_counts=True)
    found = np.split((times[back] > 1) | several, np.cumsum(sizes)[:-1])
    return _blobs([(b, c, _packed(np.packbits(f))) for (b, c, *_), f in zip(sent, found, strict=True) if f.any()])


def _wanted(chunk: Chunk, flags: pa.Table, buckets: int) -> np.ndarray:
    """The runs of a chunk whose anchor was found to be repeated."""
    anchors, _ = _sorted_anchors(chunk)
    repeated, told = np.zeros(len(anchors), dtype=bool), dict(_rows_of(flags, "bucket", "blob"))
    for b, at in _by_bucket(_bucket(anchors, buckets)):
        if b in told:
            repeated[at] = np.unpackbits(_unpacked(told[b], "u1")[0], count=len(at)).astype(bool)
    return repeated[np.searchsorted(anchors, chunk.anchor)] if len(anchors) else np.zeros(0, dtype=bool)


def _send_segments(buckets: int):
    def run(docs: pa.Table, flags: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _blobs([])
        chunk = chunk_of(_rows_of(docs, "doc_id", "text"))
        segments, _, low, anchor = _segments(chunk, _wanted(chunk, flags, buckets))
        rows, number = [], docs.column("chunk")[0].as_py()
        for b, at in _by_bucket(_bucket(anchor, buckets)):
            own = [segments[k] for k in at.tolist()]
            sizes = np.array([len(s) for s in own], dtype="<i4")
            rows.append((b, number, _packed(sizes, np.frombuffer(b"".join(own), np.uint8), low[at])))
        return _blobs(rows)

    return run


def _solve(blobs: pa.Table) -> pa.Table:
    """One shard: the smallest id of each string of each segment, for the chunks that sent them."""
    known: dict[bytes, int] = {}
    least: list[int] = []
    sent = []
    for b, c, blob in _rows_of(blobs, "bucket", "chunk", "blob"):
        sizes, raw, low = _unpacked(blob, "<i4", "u1", "<i8")
        raw, ends = raw.tobytes(), np.cumsum(sizes).tolist()
        which = []
        for start, end, smallest in zip([0, *ends[:-1]], ends, low.tolist(), strict=True):
            k = known.setdefault(raw[start:end], len(known))
            if k == len(least):
                least.append(smallest)
            elif smallest < least[k]:
                least[k] = smallest
            which.append(k)
        sent.append((b, c, np.array(which, dtype=np.int64)))
    segments = list(known)
    found = answer(segments, np.array(least, dtype=ID))
    counts = np.array([len(s) for s in segments], dtype=np.int64) - LENGTH + 1
    begins = np.cumsum(counts) - counts
    rows = []
    for b, c, which in sent:
        own = counts[which]
        at = np.repeat(begins[which] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        rows.append((b, c, _packed(found[at])))
    return _blobs(rows)


def _remove(buckets: int):
    def run(docs: pa.Table, flags: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = chunk_of(_rows_of(docs, "doc_id", "text"))
        wanted = _wanted(chunk, flags, buckets)
        segments, which, _, anchor = _segments(chunk, wanted)
        counts = np.array([len(s) for s in segments], dtype=np.int64) - LENGTH + 1
        begins = np.cumsum(counts) - counts
        least, told = np.zeros(int(counts.sum()), dtype=ID), dict(_rows_of(answers, "bucket", "blob"))
        for b, at in _by_bucket(_bucket(anchor, buckets)):
            own = counts[at]
            places = np.repeat(begins[at] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            least[places] = _unpacked(told[b], "<i8")[0]
        runs = np.flatnonzero(wanted)
        count = chunk.count[runs]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        strings = np.repeat(chunk.first[runs], count) + step
        owners = np.repeat(np.array([i or 0 for i in chunk.ids], dtype=ID)[chunk.doc[runs]], count)
        hits = strings[least[np.repeat(begins[which], count) + step] < owners]
        edge = np.zeros(len(chunk.data) + LENGTH + 1, dtype=np.int32)
        # A string is in one run only, so no place comes twice.
        edge[hits] += 1
        edge[hits + LENGTH] -= 1
        gone = (np.cumsum(edge)[: len(chunk.data)] > 0).astype(np.int8)
        rows = []
        for n, (name, raw) in enumerate(zip(chunk.ids, chunk.texts, strict=True)):
            own = gone[chunk.starts[n] : chunk.starts[n + 1]]
            kept = raw
            if own.any():
                kept = np.frombuffer(raw, np.uint8)[own == 0].tobytes()
            spans = int((np.diff(own, prepend=np.int8(0)) == 1).sum())
            # A removed run may cut a character in two; what is left of it is no text.
            text = kept.decode("utf-8", "replace")
            rows.append((name, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), text))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without an id, which keep all of their text."""
    for batch in small_batches(batches):
        texts = texts_of(batch)
        raws = [t.encode() for t in texts]
        none = pa.array([0] * len(raws), pa.int64())
        hashes = pa.array([hashlib.sha256(r).hexdigest() for r in raws])
        columns = [pa.nulls(len(raws), pa.int64()), pa.array([len(r) for r in raws], pa.int64()), none, none, hashes, pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row of ``docs``.

    Each byte is removed that a string of 50 bytes covers which also starts in a document with a smaller id; strings are judged on
    the texts as given, and never cross documents. Null and empty texts have 0 bytes. Rows with the same id do not
    remove each other's text; rows without an id keep all of theirs and remove nothing. Repeated rows come out as often
    as they come in; an empty table gives an empty one. Other columns are ignored.

    Texts are dealt to chunks of a bounded size by a hash, and this exchange is used three times: to send anchors, to
    send segments, to apply the answers. Rows without an id are not dealt at all.
    """
    every = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, nameless = every.filter("doc_id IS NOT NULL"), every.filter("doc_id IS NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = total // CHUNK_BYTES + 1
    buckets = chunks // 2 + 1
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    anchors = rows.groupBy("chunk").applyInArrow(_send_anchors(buckets), BLOB)
    flags = anchors.groupBy("bucket").applyInArrow(_find_repeated, BLOB)
    segments = rows.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(_send_segments(buckets), BLOB)
    answers = segments.groupBy("bucket").applyInArrow(_solve, BLOB)
    told = flags.withColumn("kind", F.lit(0)).unionByName(answers.withColumn("kind", F.lit(1)))
    remove = _remove(buckets)

    def run(texts: pa.Table, news: pa.Table) -> pa.Table:
        kinds = np.array(news.column("kind").to_pylist(), dtype=np.int64)
        return remove(texts, news.filter(pa.array(kinds == 0)), news.filter(pa.array(kinds == 1)))

    done = rows.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, OUT)
    return done.unionByName(nameless.mapInArrow(_untouched, OUT))
