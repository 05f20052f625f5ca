"""Toxicity: a convolutional text classifier trained in numpy.

Words are hashed to embeddings (rows for the word and for its first letters, added). Filters of several widths run
over the whole text; each keeps its largest value; a linear layer makes the logit. Thresholds for rejecting a document
are calibrated by language on labelled rows that the training did not see.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.common import lower_words, stored



# Rows of the embedding table: one for padding, then those of whole words and those of the first letters.
WORD_ROWS, PREFIX_ROWS = 1 << 16, 1 << 14
PREFIXES = (3, 5)
# Words convolved at once: bounds the memory of a very long text.
WORDS_AT_ONCE = 1 << 15
MAX_KNOWN = 200_000
# Bins of calibration for each unit of the logit.
BINS_A_LOGIT = 256


@dataclass(frozen=True)
class Settings:
    """How the model is built. ``rows_a_class`` bounds the labelled sample that the driver trains on, and
    ``longest`` leaves texts of more characters out of that sample (never out of calibration or scoring)."""

    rows_a_class: int = 3000
    longest: int = 60_000
    size: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12
    epochs: int = 5
    batch: int = 32
    rate: float = 0.004
    seed: int = 7
    least_rows: int = 40  # of each class, for a threshold of a language's own


@dataclass
class Model:
    embeddings: np.ndarray
    filters: list[np.ndarray]  # per width: (width, size, filters)
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    prior: float | None = None  # the score of every text, where there was nothing to learn from
    thresholds: dict[str, float] = field(default_factory=dict)


class Rows(dict):
    """From words to rows of a growing table that names each word's embeddings: its own, and one for each length of its
    first letters. Row 0 is padding."""

    def __init__(self) -> None:
        super().__init__()
        self.table = np.zeros((1024, 1 + len(PREFIXES)), dtype=np.int32)
        self._prefixes: dict[str, int] = {}

    def _prefix(self, part: str, kind: int) -> int:
        key = f"{kind}{part}"
        if key not in self._prefixes:
            self._prefixes[key] = 1 + WORD_ROWS + zlib.crc32(key.encode()) % PREFIX_ROWS
        return self._prefixes[key]

    def __missing__(self, word: bytes) -> int:
        row = len(self) + 1
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        letters = word.decode("utf-8", "replace")
        self.table[row] = (1 + zlib.crc32(word) % WORD_ROWS, *(self._prefix(letters[:n], n) for n in PREFIXES))
        self[word] = row
        return row

    def clear(self) -> None:
        super().clear()
        self._prefixes.clear()


# Kept by each Python worker over its tasks; says nothing of a model.
ROWS = Rows()


def convolve(x: np.ndarray, filters: np.ndarray, bias: np.ndarray, count: int) -> np.ndarray:
    """Values of one width's filters at the first ``count`` places of ``x``, which is padded to fit the last of them."""
    values = x[:count] @ filters[0]
    for k in range(1, len(filters)):
        values += x[k : k + count] @ filters[k]
    return values + bias


def _segments(found: list[int], pad: int) -> Iterator[tuple[list[int], int]]:
    """A text's words in runs of a bounded length, each with what the filters see beyond its end; and the run's length."""
    for start in range(0, max(len(found), 1), WORDS_AT_ONCE):
        run = found[start : start + WORDS_AT_ONCE + pad]
        count = max(1, min(WORDS_AT_ONCE, len(found) - start))
        yield run + [0] * (count + pad - len(run)), count


def _flush(segments: list[tuple[list[int], int]], model: Model, table: np.ndarray) -> np.ndarray:
    """Largest value of each filter within each segment, zero at least."""
    at = table[np.concatenate([np.array(run, dtype=np.int64) for run, _ in segments])]
    x = sum(model.embeddings[column] for column in at.T)
    starts = np.cumsum([0, *(len(run) for run, _ in segments[:-1])])
    bounds = np.stack([starts, starts + [count for _, count in segments]], axis=1).ravel()
    widest, best = max(map(len, model.filters)), []
    x = np.concatenate([x, np.zeros((widest, x.shape[1]), dtype=x.dtype)])
    for filters, bias in zip(model.filters, model.biases, strict=True):
        values = convolve(x, filters, bias, len(x) - widest + 1)
        best.append(np.maximum(np.maximum.reduceat(values, bounds, axis=0)[::2], 0))
    return np.concatenate(best, axis=1)


def score_texts(texts: list[str], model: Model) -> np.ndarray:
    """Scores from 0 to 1."""
    rows = ROWS
    if model.prior is not None:
        return np.full(len(texts), model.prior)
    pooled = np.zeros((len(texts), len(model.out)), dtype=np.float32)
    waiting, owners, size, pad = [], [], 0, max(map(len, model.filters)) - 1

    def flush() -> None:
        if waiting:
            np.maximum.at(pooled, owners, _flush(waiting, model, rows.table))
            waiting.clear()
            owners.clear()

    for i, text in enumerate(texts):
        if len(rows) > MAX_KNOWN:
            flush()
            rows.clear()
        for run, count in _segments(list(map(rows.__getitem__, lower_words(text))), pad):
            waiting.append((run, count))
            owners.append(i)
            size += len(run)
            if size >= WORDS_AT_ONCE:
                flush()
                size = 0
    flush()
    logits = pooled @ model.out + model.out_bias
    return 1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -60, 60)))


# --- training ---------------------------------------------------------------------------------------------------------


class _Adam:
    def __init__(self, shape: tuple[int, ...], rate: float) -> None:
        self.m, self.v, self.t, self.rate = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0, rate

    def step(self, value: np.ndarray, gradient: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient**2 - self.v)
        value -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _step_rows(table: np.ndarray, sums: np.ndarray, at: np.ndarray, gradient: np.ndarray, rate: float) -> None:
    """Adagrad on the rows that took part."""
    rows, back = np.unique(at, return_inverse=True)
    total = np.zeros((len(rows), table.shape[1]), dtype=np.float32)
    np.add.at(total, back, gradient)
    sums[rows] += total**2
    table[rows] -= rate * total / (np.sqrt(sums[rows]) + 1e-6)


def train(texts: list[str], labels: list[int], settings: Settings) -> Model:
    """Fit the network by gradient steps on whole texts. With no rows, or one class only, the model is that constant."""
    s, random = settings, np.random.default_rng(settings.seed)
    y = np.array(labels, dtype=np.float32)
    model = Model(
        embeddings=random.normal(0, 0.1, (1 + WORD_ROWS + PREFIX_ROWS, s.size)).astype(np.float32),
        filters=[random.normal(0, 1 / np.sqrt(w * s.size), (w, s.size, s.filters)).astype(np.float32) for w in s.widths],
        biases=[np.zeros(s.filters, dtype=np.float32) for _ in s.widths],
        out=random.normal(0, 0.3, s.filters * len(s.widths)).astype(np.float32),
        out_bias=0.0,
    )
    if len(set(labels)) < 2:
        model.prior = float(y.mean()) if len(y) else 0.0
        return model
    model.embeddings[0] = 0
    rows, docs, pad = Rows(), [], max(s.widths) - 1
    for text in texts:
        found = list(map(rows.__getitem__, lower_words(text)))
        docs.append(rows.table[np.array(found + [0] * (pad + (not found)), dtype=np.int64)])
    sums = np.zeros_like(model.embeddings)
    steps = [_Adam(f.shape, s.rate) for f in model.filters], [_Adam(b.shape, s.rate) for b in model.biases]
    out_step, bias_step, out_bias = _Adam(model.out.shape, s.rate), _Adam((1,), s.rate), np.zeros(1, np.float32)
    for _ in range(s.epochs):
        order = random.permutation(len(docs))
        for start in range(0, len(order), s.batch):
            chosen = order[start : start + s.batch]
            pooled, tops, inputs = [], [], []
            for d in chosen:
                at = docs[d]
                x = model.embeddings[at].sum(axis=1)
                best, where = [], []
                for filters, bias in zip(model.filters, model.biases, strict=True):
                    values = convolve(x, filters, bias, len(x) - pad)
                    top = values.argmax(axis=0)
                    where.append(top)
                    best.append(np.maximum(values[top, np.arange(len(bias))], 0))
                pooled.append(np.concatenate(best))
                tops.append(where)
                inputs.append(x)
            pooled = np.array(pooled, dtype=np.float32)
            logits = pooled @ model.out + out_bias[0]
            error = (1 / (1 + np.exp(-np.clip(logits, -60, 60))) - y[chosen]) / len(chosen)
            back = error[:, None] * model.out[None, :] * (pooled > 0)
            out_step.step(model.out, pooled.T @ error)
            bias_step.step(out_bias, error.sum(keepdims=True))
            rows_at, rows_gradient = [], []
            for k, filters in enumerate(model.filters):
                own = slice(k * s.filters, (k + 1) * s.filters)
                gradient = np.zeros_like(filters)
                for i, d in enumerate(chosen):
                    places = tops[i][k][None, :] + np.arange(len(filters))[:, None]  # (width, filters)
                    gradient += inputs[i][places].transpose(0, 2, 1) * back[i, own][None, None, :]
                    rows_at.append(docs[d][places].reshape(-1, 1 + len(PREFIXES)))
                    rows_gradient.append((filters * back[i, own]).transpose(0, 2, 1).reshape(-1, s.size))
                steps[0][k].step(filters, gradient)
                steps[1][k].step(model.biases[k], back[:, own].sum(axis=0))
            at, gradient = np.concatenate(rows_at), np.concatenate(rows_gradient)
            real = (at[:, 0] > 0) & (np.abs(gradient).max(axis=1) > 0)
            for column in at[real].T:
                _step_rows(model.embeddings, sums, column, gradient[real], 0.05)
    model.out_bias = float(out_bias[0])
    return model


def best_cut(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray, highest: np.ndarray | None = None) -> float:
    """The score from which on rejecting gives the best F1; between two scores, the middle (of the logits).

    A row may stand for several: as many as it weighs, with scores from its own up to its ``highest``.
    """
    order = np.argsort(-scores, kind="stable")
    s, y, w = scores[order], labels[order] * weights[order], weights[order]
    top = s if highest is None else highest[order]
    hits, taken = np.cumsum(y), np.cumsum(w)
    ends = np.append(s[1:] != s[:-1], True)
    f1 = np.where(ends, 2 * hits / (taken + y.sum() + 1e-12), -1)
    at = int(f1.argmax())
    logit = [float(np.log(max(x, 1e-12) / max(1 - x, 1e-12))) for x in (s[at], top[at + 1] if at + 1 < len(s) else s[at] / 2)]
    return float(1 / (1 + np.exp(-sum(logit) / 2)))


# --- Spark ------------------------------------------------------------------------------------------------------------


def fold(key: Column) -> Column:
    """Fold of a document, 0 to 4; rows without an id are in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5, F.lit(0))


def _cut(rows: list) -> float:
    """Best cut over counted bins ``(bin, low, high, good, bad)``."""
    low, high = (np.repeat([r[k] for r in rows], 2) for k in ("low", "high"))
    return best_cut(low, np.tile([0, 1], len(rows)), np.array([[r.good, r.bad] for r in rows], dtype=float).ravel(), high)


def calibrate(model: Model, docs: DataFrame, labels: DataFrame, settings: Settings) -> None:
    """Shift the model's bias so that 0.5 is its best cut over all, then set the cut of each language with rows enough.

    All rows of ``labels`` (``doc_id``, ``toxic``) count, by whole texts of any length. Only counts by bins of the
    logit reach the driver, with the lowest and the highest score in each: cuts lie between bins.
    """
    if model.prior is not None:
        return
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
    rows = rows.filter(fold(F.col("doc_id")) == 1)
    # Texts stay where they are: of repeated documents the first counts, by its beginning and a hash.
    rows = rows.select("doc_id", F.struct(F.substring("text", 1, 100).alias("a"), F.xxhash64("text").alias("b"), "lang", score(rows, model).alias("score")).alias("t"))
    rows = rows.groupBy("doc_id").agg(F.min("t").alias("t")).join(labels, "doc_id").select("t.lang", "t.score", "toxic")
    held = F.least(F.greatest(F.col("score"), F.lit(1e-12)), F.lit(1 - 1e-12))
    place = F.floor(F.log(held / (1 - held)) * BINS_A_LOGIT)
    measures = [F.min("low").alias("low"), F.max("high").alias("high"), F.sum("good").alias("good"), F.sum("bad").alias("bad")]
    rows = rows.select("lang", place.alias("bin"), F.col("score").alias("low"), F.col("score").alias("high"), (1 - F.col("toxic")).alias("good"), F.col("toxic").alias("bad"))
    bins = stored(rows.groupBy("lang", "bin").agg(*measures), "bins")
    everything = bins.groupBy("bin").agg(*measures).orderBy("bin").collect()
    if not sum(r.good for r in everything) or not sum(r.bad for r in everything):
        return
    cut = _cut(everything)
    shift = float(np.log(cut / (1 - cut)))
    model.out_bias -= shift
    enough = bins.groupBy("lang").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    enough = enough.filter(F.least("good", "bad") >= settings.least_rows).select("lang")
    own: dict[str, list] = {}
    for r in bins.join(enough, "lang", "left_semi").collect():
        own.setdefault(r.lang, []).append(r)
    for lang, found in sorted(own.items()):
        cut = _cut(sorted(found, key=lambda r: r.bin))
        model.thresholds[lang] = float(1 / (1 + np.exp(shift - np.log(cut / (1 - cut)))))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on folds 2 to 4 and calibrate on fold 1 of the labelled rows; fold 0 is never looked at.

    The training sample is bounded: of each class, the ``rows_a_class`` labelled rows that come first in the order of a
    hash of their id, without texts over ``longest``. Calibration takes all labelled rows of its fold. Labels other than
    0 and 1, and rows without an id, are left out; a document labelled twice counts as toxic if one label says so; of
    repeated documents the first text counts.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(fold(F.col("doc_id")) != 0)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held = fold(F.col("doc_id")) == 1
    parts = [rows.filter(~held & (F.col("toxic") == toxic)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.rows_a_class) for toxic in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
    texts = texts.filter(F.length("text") <= settings.longest)
    # At most twice rows_a_class ids.
    found = texts.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("t"))
    learn = sorted(found.select("doc_id", "toxic", "t.text").collect())
    model = train([r.text for r in learn], [r.toxic for r in learn], settings)
    calibrate(model, docs, rows.filter(held), settings)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of each whole text as a column of ``docs``: 0 to 1, from nothing but the text. Null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(score_texts([t or "" for t in batch.to_pylist()], shared.value), pa.float64())

    return run(F.col(text))


def threshold(model: Model, lang: str = "lang") -> Column:
    """The score from which on a document in its language is rejected; 0.5 for languages without a cut of their own."""
    cuts = F.lit(0.5)
    for name, cut in sorted(model.thresholds.items()):
        cuts = F.when(F.col(lang) == name, F.lit(cut)).otherwise(cuts)
    return cuts


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, lang, score, threshold, rejected)`` for every row of ``docs``.

    Null and empty texts get the score of a text without words. Repeated rows come out as often as they come in.
    Without labels the score is 0 throughout and nothing is rejected. ``docs`` must have a column ``lang``, which picks
    the threshold and is no input of the score; other columns are ignored.
    """
    model = fit(docs, labels, settings)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    scored = rows.select("doc_id", "lang", score(rows, model).alias("score"))
    return scored.withColumn("threshold", threshold(model)).withColumn("rejected", F.col("score") >= F.col("threshold"))
