"""Token ids in files of directly addressable codes.

A file splits each id into chunks of some bits. Level 0 holds the lowest chunk of every id, level 1 the next chunk of
those ids that need one, and so on. A bitmap at each level says which ids go on; a directory counts the ones before
every 512th bit, so the place of an id's next chunk is one count away, and any token or run of tokens is read without
decoding what lies before it. The widths of the levels are those that make the file smallest.

Layout, little-endian: magic, number of levels, documents, tokens; for each level its width, number of chunks and the
offsets of chunks, bitmap and directory; then document ids with a flag for null, and each document's first token.
"""

from __future__ import annotations

import json
import os
import string
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.common import new_folder, small_batches, stored, texts_of
from sluicework.llm.wordcache import WordCache

MAGIC = b"DACTOKN1"
HEAD = struct.Struct("<8sQQQ")
LEVEL = struct.Struct("<QQQQQ")
BLOCK = 512
MAX_WIDTH = 16
# A file is closed once it holds so many ids: some 60 MB of memory while it is written.
TOKENS_A_FILE = 4_000_000
TOKENS_AT_ONCE = 1_000_000
WORDS_A_TEXT = 512


# --- the code ---------------------------------------------------------------------------------------------------------


def level_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths with the fewest bits in all, by dynamic programming over the bits that the ids need."""
    top = max(1, int(ids.max(initial=1)).bit_length())
    longer = [len(ids), *(int(np.count_nonzero(ids >= 1 << b)) for b in range(1, top))]
    cost: list[tuple[float, list[int]]] = [(float("inf"), [])] * top + [(0.0, [])]
    for start in range(top - 1, -1, -1):
        for width in range(1, min(MAX_WIDTH, top - start) + 1):
            last = start + width == top
            paid = longer[start] * (width + (0 if last else 1 + 32 / BLOCK)) + cost[start + width][0]
            if paid < cost[start][0]:
                cost[start] = (paid, [width, *cost[start + width][1]])
    return cost[0][1]


def pack(chunks: np.ndarray, width: int) -> bytes:
    raw = np.ascontiguousarray(chunks.astype("<u2")).view(np.uint8).reshape(-1, 2)
    return np.packbits(np.unpackbits(raw, axis=1, count=width, bitorder="little").ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, skip: int, count: int, width: int) -> np.ndarray:
    """``count`` chunks of ``width`` bits from packed bytes, after ``skip`` bits."""
    bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), bitorder="little")[skip : skip + count * width]
    return bits.reshape(count, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def encode_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One file with the ids of some documents in a row."""
    levels, left = [], ids.astype(np.uint32)
    for width in level_widths(ids):
        rest = left >> np.uint32(width)
        more = rest > 0
        bitmap = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
        directory = (np.cumsum(ones, dtype=np.uint64) - ones).astype("<u8")
        levels.append((width, len(left), pack(left & np.uint32((1 << width) - 1), width), bitmap.tobytes(), directory.tobytes()))
        left = rest[more]
    offset = HEAD.size + LEVEL.size * len(levels)
    table, body = [], []
    for width, count, *sections in levels:
        places = []
        for section in sections:
            places.append(offset)
            offset += len(section)
            body.append(section)
        table.append(LEVEL.pack(width, count, *places))
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    named = np.array([d or 0 for d in doc_ids], dtype="<i8")
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    head = HEAD.pack(MAGIC, len(levels), len(doc_ids), len(ids))
    return b"".join([head, *table, *body, named.tobytes(), known.tobytes(), starts.tobytes()])


class TokenFile:
    """Reads a file of ids: any token, any run of tokens, any document. Only the bytes needed are fetched."""

    def __init__(self, source: pa.NativeFile) -> None:
        self._source = source
        magic, levels, docs, self.n_tokens = HEAD.unpack(source.read_at(HEAD.size, 0))
        if magic != MAGIC:
            raise ValueError("not a token file")
        table = source.read_at(LEVEL.size * levels, HEAD.size)
        self._levels = [LEVEL.unpack_from(table, i * LEVEL.size) for i in range(levels)]
        size = docs * 17 + 8
        tail = source.read_at(size, source.size() - size)
        known = np.frombuffer(tail, np.uint8, docs, docs * 8)
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(tail, "<i8", docs), known, strict=True)]
        self.starts = np.frombuffer(tail, "<u8", docs + 1, docs * 9).astype(np.int64)

    def _bits(self, place: int, start: int, stop: int) -> np.ndarray:
        raw = self._source.read_at((stop + 7) // 8 - start // 8, place + start // 8)
        return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), bitorder="little")[start % 8 : start % 8 + stop - start]

    def _rank(self, bitmap: int, directory: int, place: int) -> int:
        """Ones in the bitmap before ``place``: a directory entry and the bits of one block."""
        block = place // BLOCK
        before = int.from_bytes(self._source.read_at(8, directory + 8 * block), "little")
        return before + int(self._bits(bitmap, block * BLOCK, place).sum()) if place % BLOCK else before

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` up to ``stop``."""
        if not 0 <= start <= stop <= self.n_tokens:
            raise IndexError((start, stop))
        out = np.zeros(stop - start, dtype=np.uint32)
        reached, shift = np.arange(stop - start), 0
        for width, count, chunks, bitmap, directory in self._levels:
            if start == stop:
                break
            first, last = start * width, stop * width
            raw = self._source.read_at((last + 7) // 8 - first // 8, chunks + first // 8)
            out[reached] |= unpack(raw, first % 8, stop - start, width) << np.uint32(shift)
            more = self._bits(bitmap, start, stop).astype(bool)
            reached, shift = reached[more], shift + width
            start = self._rank(bitmap, directory, start) if start < count else 0
            stop = start + len(reached)
        return out

    def token(self, place: int) -> int:
        return int(self.read(place, place + 1)[0])

    def document(self, number: int) -> np.ndarray:
        return self.read(int(self.starts[number]), int(self.starts[number + 1]))


def open_file(path: str) -> TokenFile:
    where, name = fs.FileSystem.from_uri(path)
    return TokenFile(where.open_input_file(name))


# --- tokenizing -------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=4)
def _words_of(tokenizer: str) -> WordCache:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, pre_tokenizers

    model = Tokenizer.from_file(tokenizer)
    # For words of ASCII letters in lower case, which nothing else changes or cuts.
    bare = Tokenizer(model.model)
    bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    suffix = json.loads(model.to_str())["model"].get("end_of_word_suffix") or ""
    ends = np.zeros(model.get_vocab_size(), dtype=bool)
    ends[[i for token, i in model.get_vocab().items() if suffix and token.endswith(suffix)]] = True

    def one_by_one(words: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in model.encode_batch_fast(words, add_special_tokens=False)]

    def encode(words: list[bytes]) -> list[bytes]:
        """Words of letters only are encoded as one text, which is cheaper, and told apart by the tokens that end words."""
        texts = [w.decode() for w in words]
        kinds: tuple[list[int], list[int], list[int]] = ([], [], [])
        for k, t in enumerate(texts):
            kinds[(0 if t.isascii() else 1) if t.isalpha() else 2].append(k)
        plain, letters, others = kinds
        found: list[bytes] = [b""] * len(words)
        for coder, chosen in ((bare, plain), (model, letters)):
            for start in range(0, len(chosen), WORDS_A_TEXT):
                part = chosen[start : start + WORDS_A_TEXT]
                (coded,) = coder.encode_batch_fast([" ".join([texts[k] for k in part])], add_special_tokens=False)
                ids = np.array(coded.ids, dtype="<u4")
                cuts = np.flatnonzero(ends[ids]) + 1
                if len(cuts) == len(part):
                    raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
                    for k, a, b in zip(part, at, at[1:], strict=False):
                        found[k] = raw[a:b]
                else:
                    others += part
        for k, raw in zip(others, one_by_one([texts[k] for k in others]), strict=True):
            found[k] = raw
        return found

    return WordCache(encode)


_SPACE, _ALNUM, _MARK = (np.array([chr(c) in x if c < 128 else False for c in range(256)]) for x in (" \t\n\v\f\r", string.ascii_letters + string.digits, string.punctuation))


def _special(raw: bytes) -> bool:
    """Special tokens hold marks and are not put into lower case."""
    return b"<|" in raw


def _word_ids(raw: bytes, tokenizer: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all words of some bytes, and for each word where it starts and how many ids it has.

    Words are told apart by arrays of bytes; each different one is looked up once and its ids are gathered.
    """
    data = np.frombuffer(raw, dtype=np.uint8)
    space = _SPACE[data]
    after = np.concatenate([[True], space[:-1]])
    cut = np.concatenate([[False], _ALNUM[data[:-1]] & _MARK[data[1:]]]) if len(data) and not _special(raw) else False
    first = ~space & (after | cut)
    starts, kept = np.flatnonzero(first), data[~space]
    if not len(starts):
        return np.zeros(0, np.uint32), starts, starts
    offsets = np.append(np.flatnonzero(first[~space]), len(kept)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).dictionary_encode()
    parts = _words_of(tokenizer).look_up(words.dictionary.to_pylist())
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
    flat, begins = np.frombuffer(b"".join(parts), dtype="<u4"), np.cumsum(sizes) - sizes
    which = words.indices.to_numpy()
    counts = sizes[which]
    places = np.repeat(begins[which] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    return flat[places], starts, counts


def tokenize_all(texts: list[str], tokenizer: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some texts in a row, each followed by the end id, and how many each text has.

    The tokenizer drops white space, lowers case and ends words where letters or digits end. The ids of a text are then
    those of its words in a row (split at ASCII white space and before marks; texts with the opening of special tokens
    at white space only), and words that come again are not encoded again.
    """
    raws = [t.encode() for t in texts]
    if any(map(_special, raws)) and len(raws) > 1:
        parts = [tokenize_all([t], tokenizer, end) for t in texts]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    whole = b"\n".join(raws)
    ids, starts, counts = _word_ids(whole if _special(whole) else whole.lower(), tokenizer)
    ends = np.cumsum([len(r) + 1 for r in raws])
    before = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, ends)]
    return np.insert(ids, before, end).astype(np.uint32), np.diff(before, prepend=0) + 1


def tokenize(text: str, tokenizer: str, end: int) -> np.ndarray:
    """Ids of a text and the end id."""
    return tokenize_all([text], tokenizer, end)[0]


# --- files ------------------------------------------------------------------------------------------------------------


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write the ids of all documents to files in ``folder``, in ascending order of ``doc_id``; returns the list of files.

    The list has ``(part, seq, path, n_docs, n_tokens)``; files follow one another by part, then seq. Documents are
    dealt to parts by ranges of ``doc_id`` (rows without one come first, rows with the same one in the order of a
    hash of their text, so that no id is too large for one part). A null or empty text has the end id only. A file
    gets its name when it is whole, so a task that runs again replaces it with the same bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, where = TaskContext.get().partitionId(), fs.FileSystem.from_uri(folder)
        names, lengths, pieces, size, seq = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            path = f"{where[1].rstrip('/')}/part-{part:06d}-{seq:05d}.dac"
            draft = f"{path}.{uuid.uuid4().hex}.draft"
            with where[0].open_output_stream(draft) as out:
                out.write(encode_file(names, lengths, np.concatenate(pieces)))
            where[0].move(draft, path)
            row = [part, seq, f"{folder.rstrip('/')}/{os.path.basename(path)}", len(names), size]
            return pa.RecordBatch.from_pylist([dict(zip(("part", "seq", "path", "n_docs", "n_tokens"), row, strict=True))])

        where[0].create_dir(where[1], recursive=True)
        for batch in small_batches(batches):
            ids, counts = tokenize_all(texts_of(batch), tokenizer, end)
            names += batch.column("doc_id").to_pylist()
            lengths += counts.tolist()
            pieces.append(ids)
            size += len(ids)
            if size >= TOKENS_A_FILE:
                yield close()
                names, lengths, pieces, size, seq = [], [], [], 0, seq + 1
        if names:
            yield close()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return dealt.mapInArrow(run, "part long, seq long, path string, n_docs long, n_tokens long")


def read_tokens(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files that ``write_tokens`` listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file, rows = open_file(row["path"]), []
                first = 0
                while first < len(file.doc_ids):
                    last = int(np.searchsorted(file.starts, file.starts[first] + TOKENS_AT_ONCE, side="right")) - 1
                    last = min(max(last, first + 1), len(file.doc_ids))
                    ids = file.read(int(file.starts[first]), int(file.starts[last])).astype("<u4")
                    for d in range(first, last):
                        a, b = (int(file.starts[x] - file.starts[first]) for x in (d, d + 1))
                        start = row["base"] + int(file.starts[d])
                        rows.append((file.doc_ids[d], start, b - a, zlib.crc32(ids[a:b].tobytes())))
                    first = last
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row a part, of which there are as many as the writing stage had tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.select("path", (F.col("before") + F.col("inside")).alias("base")).repartition(tasks, "path")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, tokenizer: str, end: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write the ids of all documents and read them back: one row per row of ``docs`` (none for an empty table).

    ``start`` counts the ids of all documents before it, ``n_tokens`` the document's with its end id. Other columns of
    ``docs`` are ignored.
    """
    folder = new_folder(docs.sparkSession, "tokens")
    return read_tokens(stored(write_tokens(docs, folder, tokenizer, end, text, key), "token-files"))
