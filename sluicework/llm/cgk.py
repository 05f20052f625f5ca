"""Benchmark decontamination: windows of a document within a small edit distance of a benchmark item.

Texts are compared as their lower-case words joined by single blanks. Windows of an item's size are embedded by CGK
random walks: at each step the walk shows a character and moves on or stays, as a random bit for this step and character says,
so that a small edit distance becomes a small Hamming distance. A window and an item become candidates when their
embeddings agree in one of many samples of positions; candidates are verified by exact edit distance.

Most windows of a corpus are near no item, so a filter without loss comes before the walks. An item that may have k edits is
cut into k + 2 pieces; whatever the edits are, two pieces stand unchanged within k characters of their places. Windows are
embedded only where two pieces of an item of their size say that it could start, at words, and within runs of scripts
without blanks at any character, and where a bound on shared grams of characters allows it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.common import lower_words, small_batches, texts_of

CLASSES = 128  # of characters, by code point; only the walks use them
# Windows embedded at once, and characters of benchmark items matched in one pass over the documents.
WINDOWS_AT_ONCE = 2048
# An item takes some 10 kB in a worker: 100 MB for 10,000 items of 100 characters.
ITEM_CHARS_A_PASS = 1_000_000
KNOWN_WINDOWS = 50_000
# Of a hash, looked up in a table of marks before the sorted hashes.
MARK_BITS = 20
# Characters of the grams by which places are bounded, and bins that their counts are folded into.
BOUNDS = (5, 3)
GRAM_BITS = 11
GRAM_BINS = 1 << GRAM_BITS


@dataclass(frozen=True)
class Settings:
    """``edits`` is the share of an item's characters that may be edited.

    ``samples`` samples are taken of each of ``walks`` embeddings, each of ``sample`` positions within ``stretch`` steps:
    where two walks are in step they stay so until the next edit, so neighbouring positions agree together. With the
    defaults the recall under edits of a tenth of all characters is above 0.99, and a window meets 2 to 7 of 100 items by
    chance (see the tests).
    """

    edits: float = 0.1
    walks: int = 8
    samples: int = 32
    sample: int = 12
    stretch: int = 24
    random: int = 11


def edit_distance(masks: dict[str, int], length: int, text: str, most: int) -> int:
    """Least Levenshtein distance between a pattern, given by its bit masks, and a beginning of ``text`` (Myers' bit
    vectors); some number above ``most`` if it is more than that."""
    full = (1 << length) - 1
    top, plus, minus, distance, least = 1 << (length - 1), full, 0, length, length
    for c in text[: length + most]:
        same = masks.get(c, 0)
        x = same | minus
        d = (((same & plus) + plus) ^ plus) | same
        up = minus | (~(d | plus) & full)
        down = plus & d
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
            least = min(least, distance)
        up = ((up << 1) | 1) & full
        down = (down << 1) & full
        plus = down | (~(x | up) & full)
        minus = up & x
    return least


def _pairs(text: str) -> np.ndarray:
    """How often each pair of neighbouring characters occurs, pairs folded into some bins."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return np.bincount((codes[:-1] * 37 + codes[1:]) % 1021, minlength=1021).clip(max=32_767).astype(np.int16)


# Scripts without blanks between words, as ranges of code points.
_RUNS = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _starts(codes: np.ndarray) -> np.ndarray:
    """Characters where a window may start: those after a blank, and all of scripts without blanks."""
    starts = np.append(True, codes[:-1] == 32)
    if len(codes) and codes.max() >= _RUNS[0][0]:
        for low, high in _RUNS:
            starts |= (codes >= low) & (codes <= high)
    return np.flatnonzero(starts[: len(codes)])


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of ``size`` characters, put together from those of 1, 2, 4 and so on."""
    count, times = len(codes) - size + 1, np.uint64(0x9E3779B97F4A7C15)
    found = np.zeros(max(count, 0), dtype=np.uint64)
    if count <= 0:
        return found
    part, width, covered = codes.astype(np.uint64), 1, 0
    while width <= size:
        if size & width:
            found = found * times + part[covered : covered + count] if covered else part[:count]
            covered += width
        if 2 * width <= size:
            part = part[:-width] * times + part[width:]
            part ^= part >> np.uint64(29)
        width *= 2
    found = (found ^ (found >> np.uint64(32))) * times
    return found ^ (found >> np.uint64(31))


def _bins(codes: np.ndarray, size: int) -> np.ndarray:
    """All strings of ``size`` characters, folded into some bins."""
    return (_grams(codes, size) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def _joined(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "surrogatepass")


def _merged(ranges: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Ranges ``(item, first, last)`` of one item that overlap as one."""
    now: tuple[int, int, int] | None = None
    for i, first, last in sorted(ranges):
        if now and now[0] == i and first <= now[2] + 1:
            now = i, now[1], max(now[2], last)
            continue
        if now:
            yield now
        now = i, first, last
    if now:
        yield now


class Matcher:
    """The items of one pass, indexed by seeds and by samples of their embeddings."""

    def __init__(self, items: list[tuple[int | None, str]], settings: Settings = Settings()) -> None:
        self.settings = settings
        split = [(item, lower_words(text or "")) for item, text in items]
        self.items = [(item, words, _joined(words)) for item, words in split if words]
        self.most = [int(settings.edits * len(text)) for *_, text in self.items]
        pieces: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        self.needed: list[int] = []
        for i, (_, _, text) in enumerate(self.items):
            # An item too short for so many pieces has fewer, of which as many less stand.
            count, codes = min(self.most[i] + 2, len(text)), _codes(text)
            self.needed.append(count - self.most[i])
            size = len(text) // count
            grams = _grams(codes, size)
            pieces[size].extend((int(grams[at]), i, at) for at in (j * len(text) // count for j in range(count)))
        # Per size of pieces: marks of hashes' high bits, sorted hashes, and for each its item and offset.
        self.pieces: dict[int, tuple[np.ndarray, ...]] = {}
        for size, found in pieces.items():
            found.sort()
            hashes = np.array([h for h, *_ in found], dtype=np.uint64)
            marks = np.zeros(1 << MARK_BITS, dtype=bool)
            marks[hashes >> np.uint64(64 - MARK_BITS)] = True
            self.pieces[size] = marks, hashes, np.array([i for _, i, _ in found]), np.array([at for *_, at in found])
        self.by_words: dict[int, list[int]] = defaultdict(list)
        for i, (_, words, _) in enumerate(self.items):
            self.by_words[len(words)].append(i)
        self.masks = [self._masks(text) for *_, text in self.items]
        self.pairs = [_pairs(text) for *_, text in self.items]
        self.grams = [[np.bincount(_bins(_codes(text), g), minlength=GRAM_BINS).clip(max=32_767).astype(np.int16) for g in BOUNDS] for *_, text in self.items]
        self._prepare_samples()
        self._known: dict[tuple[int, str, str], list[tuple[int, int]]] = {}

    @staticmethod
    def _masks(text: str) -> dict[str, int]:
        masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(text):
            masks[c] |= 1 << i
        return dict(masks)

    # --- embeddings ---------------------------------------------------------------------------------------------------

    def _prepare_samples(self) -> None:
        s, random = self.settings, np.random.default_rng(self.settings.random)
        # A walk moves at every second step on average, so twice an item's length shows all of it.
        self.steps = 2 * max((len(text) for *_, text in self.items), default=1)
        self.moves = random.integers(0, 2, (self.steps, s.walks, CLASSES), dtype=np.int64)
        self.places, self.tables = {}, {}
        for n, members in sorted(self.by_words.items()):
            reach = 2 * min(len(self.items[i][2]) for i in members)
            near = random.integers(0, max(1, reach - s.stretch + 1), (s.walks, s.samples, 1))
            self.places[n] = np.minimum(near + random.integers(0, s.stretch, (s.walks, s.samples, s.sample)), reach - 1)
            keys = self._keys(self.embed([self.items[i][2] for i in members]), n)
            owners = np.repeat(np.array(members), keys.shape[1])
            order = np.argsort(keys.ravel(), kind="stable")
            self.tables[n] = keys.ravel()[order], owners[order]

    def embed(self, texts: list[str]) -> np.ndarray:
        """CGK embeddings, (texts, walks, steps); class 0 beyond a text's end."""
        longest = max(map(len, texts)) + 1
        chars = np.zeros((len(texts), longest), dtype=np.uint8)
        for i, text in enumerate(texts):
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
            chars[i, : len(codes)] = 1 + codes % (CLASSES - 1)
        walks = self.settings.walks
        flat, base = chars.ravel(), np.repeat(np.arange(len(texts)) * longest, walks)
        end, at = base + longest - 1, base.copy()
        which = np.tile(np.arange(walks) * CLASSES, len(texts))
        out = np.zeros((self.steps, len(base)), dtype=np.uint8)
        for step, moves in enumerate(self.moves.reshape(self.steps, -1)):
            shown = flat[at]
            out[step] = shown
            at = np.minimum(at + moves[which + shown], end)
        return out.reshape(self.steps, len(texts), walks).transpose(1, 2, 0)

    def _keys(self, embedded: np.ndarray, words: int) -> np.ndarray:
        """Keys of all samples with their numbers, (texts, walks * samples)."""
        places = self.places[words]
        key = np.zeros((len(embedded), *places.shape[:2]), dtype=np.uint64)
        for k in range(places.shape[2]):
            shown = np.take_along_axis(embedded, np.broadcast_to(places[None, :, :, k], key.shape), axis=2)
            key = (key ^ shown) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        key = key.reshape(len(embedded), -1)
        return (key << np.uint64(12)) ^ np.arange(key.shape[1], dtype=np.uint64)

    # --- matching -----------------------------------------------------------------------------------------------------

    def _places(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """``(item, first, last)``: ranges of characters where an item may start."""
        found: list[tuple[int, int, int]] = []
        if not len(codes):
            return found
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for size, (marks, hashes, items, offsets) in self.pieces.items():
            grams = _grams(codes, size)
            at = np.flatnonzero(marks[grams >> np.uint64(64 - MARK_BITS)])
            low, high = np.searchsorted(hashes, grams[at], "left"), np.searchsorted(hashes, grams[at], "right")
            counts = high - low
            rows = np.repeat(low - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(counts.sum())
            met.append((items[rows], np.repeat(at, counts) - offsets[rows], offsets[rows]))
        item, start, offset = (np.concatenate(c) for c in zip(*met, strict=True))
        most, needed = np.array(self.most), np.array(self.needed)
        order = np.lexsort((offset, start, item))
        item, start, offset = item[order], start[order], offset[order]
        # Two pieces in their places put the item's start within k of both: among those in order, two neighbours do.
        k = most[item[:-1]]
        pair = (item[1:] == item[:-1]) & (offset[1:] != offset[:-1]) & (start[1:] - start[:-1] <= 2 * k)
        alone = needed[item] == 1
        ranges = [
            *zip(item[:-1][pair].tolist(), (start[1:] - k)[pair].tolist(), (start[:-1] + k)[pair].tolist(), strict=True),
            *zip(item[alone].tolist(), (start - most[item])[alone].tolist(), (start + most[item])[alone].tolist(), strict=True),
        ]
        bins: list[np.ndarray] = []
        for i, first, last in _merged(ranges):
            k, n, first = self.most[i], len(self.items[i][2]), max(0, first)
            bins = bins or [_bins(codes, g) for g in BOUNDS]
            # An edit takes away as many grams as they have characters at most.
            if last >= first and all(
                np.maximum(own - np.bincount(all_of[first : max(first, last + n + k - g + 1)], minlength=GRAM_BINS), 0).sum() <= g * k
                for g, own, all_of in zip(BOUNDS, self.grams[i], bins, strict=True)
            ):
                found.append((i, first, last))
        return found

    def _candidates(self, texts: list[str], words: int) -> list[set[int]]:
        """For windows of an item's number of words, the items whose embeddings agree with theirs in some sample."""
        known, owners = self.tables[words]
        keys = self._keys(self.embed(texts), words)
        low, high = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
        found: list[set[int]] = [set() for _ in texts]
        for row, sample in zip(*np.nonzero(high > low), strict=True):
            found[row].update(owners[low[row, sample] : high[row, sample]].tolist())
        return found

    def _match(self, texts: list[tuple[int, str, str]]) -> list[list[tuple[int, int]]]:
        """For windows (words of the item, text, text and what follows): the items within the allowed distance of the
        window, or of one that ends somewhat later or earlier, as (item, distance)."""
        results: list[list[tuple[int, int]]] = [[] for _ in texts]
        sizes = np.array([n for n, *_ in texts])
        for n in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == n).tolist()
            for row, candidates in zip(rows, self._candidates([texts[r][1] for r in rows], n), strict=True):
                pairs = _pairs(texts[row][2])
                for i in sorted(candidates):
                    pattern = self.items[i][2]
                    most = self.most[i]
                    if not most and not self._whole(pattern, texts[row][2]):
                        continue
                    # An edit takes away two pairs of neighbours at most.
                    if np.maximum(self.pairs[i] - pairs, 0).sum() > 2 * most:
                        continue
                    distance = 0 if texts[row][1] == pattern else edit_distance(self.masks[i], len(pattern), texts[row][2], most)
                    if distance <= most:
                        results[row].append((i, distance))
        return results

    @staticmethod
    def _whole(pattern: str, text: str) -> bool:
        """Whether a text begins with a pattern that ends where a word does."""
        return text.startswith(pattern) and len(pattern) in (len(text), *_starts(_codes(text)).tolist(), text.find(" ", len(pattern)))

    def hits(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """For each text, ``(item index, first word, end word, distance)`` of every item in it: its best window."""
        best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        waiting: dict[tuple[int, str, str], set[tuple[int, int, int]]] = defaultdict(set)

        def settle(places: set[tuple[int, int, int]], found: list[tuple[int, int]]) -> None:
            for doc, start, end in places:
                for i, distance in found:
                    best[doc][i] = min(best[doc].get(i, (distance, start, end)), (distance, start, end))

        def flush() -> None:
            windows = list(waiting)
            for start in range(0, len(windows), WINDOWS_AT_ONCE):
                part = windows[start : start + WINDOWS_AT_ONCE]
                for window, found in zip(part, self._match(part), strict=True):
                    settle(waiting[window], found)
                    self._known[window] = found
            waiting.clear()

        for doc, text in enumerate(texts):
            words = lower_words(text)
            joined = _joined(words)
            codes = _codes(joined)
            places = self._places(codes)
            if not places:
                continue
            starts, blanks = _starts(codes), np.flatnonzero(codes == 32)
            for i, first, last in places:
                size, length = len(self.items[i][1]), len(self.items[i][2])
                for at in starts[np.searchsorted(starts, first) : np.searchsorted(starts, last, "right")].tolist():
                    word = int(np.searchsorted(blanks, at))
                    # One character more shows whether a word ends.
                    window = size, joined[at : at + length], joined[at : at + length + self.most[i] + 1]
                    where = doc, word, min(len(words), word + size)
                    if window in self._known:
                        settle({where}, self._known[window])
                    else:
                        waiting[window].add(where)
            if len(waiting) >= WINDOWS_AT_ONCE:
                flush()
            if len(self._known) > KNOWN_WINDOWS:
                self._known.clear()
        if waiting:
            flush()
        return [[(i, s, e, d) for i, (d, s, e) in sorted(b.items())] for b in best]


class Pass:
    """The items of one pass over the documents. Only their texts travel; each worker builds the matcher once."""

    def __init__(self, items: list[tuple[int | None, str]], settings: Settings) -> None:
        self.items, self.settings = items, settings
        self._matcher: Matcher | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_matcher": None}

    def matcher(self) -> Matcher:
        self._matcher = self._matcher or Matcher(self.items, self.settings)
        return self._matcher


def passes(benchmark: DataFrame, settings: Settings) -> Iterator[Pass]:
    """All items of the benchmark in passes of a bounded size; the driver holds one at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // ITEM_CHARS_A_PASS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        items = sorted(((r.item_id, r.text) for r in rows.filter(part == k).collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        items = [(i, t) for i, t in items if lower_words(t)]
        if items:
            yield Pass(items, settings)


OUT = "doc_id long, item_id long, first_word long, end_word long, distance long"


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, item_id, first_word, end_word, distance)``: one row for each row of ``docs`` and each item in it.

    The best window is given, the first of equals. Null and empty texts, and items without words, match nothing; so
    does an empty table. Repeated documents and repeated items give repeated rows. A null id stays null. Other columns
    are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.sparkSession.createDataFrame([], OUT)
    for one in passes(benchmark, settings):
        shared = docs.sparkSession.sparkContext.broadcast(one)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = shared.value.matcher()
            for batch in small_batches(batches, 2048):
                ids, hits = batch.column("doc_id").to_pylist(), matcher.hits(texts_of(batch))
                out = [(d, matcher.items[i][0], *rest) for d, own in zip(ids, hits, strict=True) for i, *rest in own]
                if out:
                    columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "first_word", "end_word", "distance"])

        found = found.unionByName(rows.mapInArrow(run, OUT))
    return found


def is_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text: str = "text") -> Column:
    """Whether a text holds a benchmark item, as a column of ``docs``; false for null and empty texts."""
    def marker(shared: Broadcast) -> Callable[[Column], Column]:
        @F.arrow_udf("boolean")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                yield pa.array([bool(own) for own in shared.value.matcher().hits([t or "" for t in batch.to_pylist()])], pa.bool_())

        return run

    answer = F.lit(False)
    for one in passes(benchmark, settings):
        answer = answer | marker(docs.sparkSession.sparkContext.broadcast(one))(F.col(text))
    return answer
