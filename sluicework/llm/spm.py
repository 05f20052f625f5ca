"""SentencePiece encoding and decoding with a vocabulary of scored pieces.

An Aho-Corasick automaton over all pieces reads a text once. At each position it reports the pieces that end there,
longest first, along its output links; each of them may improve the best score of a segmentation up to that position. The best
segmentation is then read backwards. Characters of no piece become the pieces of their bytes.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from math import inf

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.wordcache import WordCache

BLANK = "▁"
# Scores are multiples of this, so that sums are exact and ties are ties on every machine.
GRAIN = 1 / 256
UNKNOWN_PENALTY = 10.0
# Texts held as Python strings at once, with their ids: some ten times this in memory. A longer text is held alone.
BYTES_AT_ONCE = 1 << 20


class Pieces:
    """A vocabulary read from a model file: its pieces with their kinds, and a score for each.

    A unigram file holds log probabilities, which are taken as they are. A file of merges holds ranks instead (0, -1,
    -2, ...); these become log probabilities by Zipf's law, log 1 / ((rank + 1) * H) with H the harmonic number.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.bytes = {int(n[3:5], 16): i for i, n in enumerate(names) if model.is_byte(i)}
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        given = {i: model.get_score(i) for i in plain}
        if given and all(s <= 0 and s == int(s) for s in given.values()):
            harmonic = float((1 / np.arange(1, len(plain) + 1)).sum())
            given = {i: -float(np.log((1 - s) * harmonic)) for i, s in given.items()}
        self.scores = {i: round(s / GRAIN) * GRAIN for i, s in given.items()}
        self.names = {i: names[i] for i in plain}
        self.unknown_id = model.unk_id()
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        # What each id stands for when decoding; control pieces stand for nothing.
        self.shown = [b""] * size
        for i, name in self.names.items():
            self.shown[i] = name.replace(BLANK, " ").encode()
        for value, i in self.bytes.items():
            self.shown[i] = bytes([value])
        if self.unknown_id >= 0:
            self.shown[self.unknown_id] = " ⁇ ".encode()


class Codec:
    """Encodes and decodes with a vocabulary."""

    def __init__(self, path: str) -> None:
        self.pieces = pieces = Pieces(path)
        self.automaton = ahocorasick.Automaton()
        for i, name in pieces.names.items():
            self.automaton.add_word(name, (len(name), pieces.scores[i], i))
        self.automaton.make_automaton()
        self._single = {name for name in pieces.names.values() if len(name) == 1}
        # No piece crosses the start of a run of blanks, nor a line end that is in no longer piece: the best
        # segmentation of a text is then that of the parts in a row, and parts that come again are known.
        crossing = any(BLANK in name.lstrip(BLANK) for name in pieces.names.values())
        lines = any("\n" in name and len(name) > 1 for name in pieces.names.values())
        part = rf"{BLANK}*[^{BLANK}]+|{BLANK}+" if lines else rf"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n"
        self._split = None if crossing else re.compile(part)
        self._words = WordCache(lambda words: [array("i", self.segment(w)).tobytes() for w in words])

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation; of equal ones, the one whose last piece is longest, and so on backwards."""
        count, unknown = len(text), self.pieces.unknown
        best = [0.0] + [-inf] * count
        if self._single.issuperset(text):
            return self._known_only(text, best)
        came = [(0, -1)] * (count + 1)
        done, single = 0, False  # positions up to ``done`` are final; whether a one-character piece ends at done + 1

        def settle(upto: int) -> None:
            nonlocal done, single
            while done < upto:
                if not single and best[done] + unknown > best[done + 1]:
                    best[done + 1], came[done + 1] = best[done] + unknown, (done, -1)
                done, single = done + 1, False

        for end, (length, score, i) in self.automaton.iter(text):
            settle(end)
            start = end + 1 - length
            if best[start] + score > best[end + 1]:
                best[end + 1], came[end + 1] = best[start] + score, (start, i)
            single = single or length == 1
        settle(count)
        ids: list[int] = []
        at = count
        while at:
            start, i = came[at]
            ids.extend((i,) if i >= 0 else reversed(self._as_bytes(text[start:at])))
            at = start
        return ids[::-1]

    def _known_only(self, text: str, best: list[float]) -> list[int]:
        """The same for a text of which each character is a piece: no position is out of reach."""
        came, last = [0] * len(best), [0] * len(best)
        for end, (length, score, i) in self.automaton.iter(text):
            start = end + 1 - length
            score += best[start]
            end += 1
            if score > best[end]:
                best[end], came[end], last[end] = score, start, i
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at = came[at]
        ids.reverse()
        return ids

    def _as_bytes(self, char: str) -> list[int]:
        known = self.pieces.bytes
        return [known.get(b, self.pieces.unknown_id) for b in char.encode("utf-8", "surrogatepass")]

    def _parts(self, text: str) -> bytes:
        if self._split is None:
            return np.array(self.segment(text), dtype="<i4").tobytes()
        return self._words.join(self._split.findall(text))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; none for an empty one. A blank is put before the text and dropped again when decoding. The
        character that stands for blanks in pieces is itself written as bytes, so that it comes back."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        literal = np.array(self._as_bytes(BLANK), dtype="<i4").tobytes()
        parts = [p.replace(" ", BLANK) for p in (" " + text).split(BLANK)]
        return np.frombuffer(literal.join(self._parts(p) for p in parts), dtype="<i4")

    def decode(self, ids: list[int]) -> str:
        """The text of some ids. Ids outside the vocabulary count as unknown; bytes that are no UTF-8 become U+FFFD."""
        shown, size = self.pieces.shown, len(self.pieces.shown)
        try:
            raw = b"".join(map(shown.__getitem__, ids)) if not ids or min(ids) >= 0 else None
        except IndexError:
            raw = None
        if raw is None:
            raw = b"".join(shown[i if 0 <= i < size else self.pieces.unknown_id] for i in ids)
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a model file, kept by each Python worker."""
    return Codec(path)


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The texts of Arrow batches, so many at a time that they hold no more than ``BYTES_AT_ONCE``, or one text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(batch):
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BYTES_AT_ONCE, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _lists(found: list[np.ndarray | None]) -> pa.ListArray:
    offsets = np.cumsum([0, *(0 if x is None else len(x) for x in found)]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *(x for x in found if x is not None)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()), mask=pa.array([x is None for x in found]))


def _texts(ids: pa.ListArray, known: Codec) -> pa.Array:
    """Row by row from the flat values: Python numbers for all ids of a batch would take a hundred times a row's."""
    values, valid = ids.values.fill_null(-1).to_numpy(), ids.is_valid().to_pylist()
    ends = ids.offsets.to_numpy()
    rows = (values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
    return pa.array((known.decode(row[row >= 0].tolist()) if ok else None for row, ok in zip(rows, valid, strict=True)), pa.string())


def encode(path: str, text: Column) -> Column:
    """Array of the ids of a text column; null stays null, an empty text has no ids."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in _slices(batches):
            yield _lists([None if t is None else codec(path).encode(t) for t in part.to_pylist()])

    return run(text)


def decode(path: str, ids: Column) -> Column:
    """The texts of an array column of ids; null stays null, nulls and negative numbers within an array are passed over."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _texts(batch, codec(path))

    return run(ids)


def recode(path: str, text: Column) -> Column:
    """Struct of the ``ids`` of a text column and the text ``decoded`` from them, both null for a null text.

    One Python worker a task does both, with one automaton and one cache, and holds the texts of one slice as Python
    strings at a time; other columns of the table do not reach it.
    """

    @F.arrow_udf("ids array<int>, decoded string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in _slices(batches):
            ids = _lists([None if t is None else codec(path).encode(t) for t in part.to_pylist()])
            yield pa.StructArray.from_arrays([ids, _texts(ids, codec(path))], names=["ids", "decoded"])

    return run(text)


def round_trip(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, ids, n_ids, decoded, same)`` for every row of ``docs``: the ids of each whole text, what they decode
    to, and whether that is the text again.

    Null texts have null ids and count as the same; an empty text has no ids. Repeated rows come out as often as they
    come in; an empty table gives an empty one. Other columns are ignored.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("code", recode(path, F.col("text"))).select("doc_id", "text", "code.ids", "code.decoded")
    return rows.select("doc_id", "ids", F.size("ids").alias("n_ids"), "decoded", F.col("decoded").eqNullSafe(F.col("text")).alias("same"))
