"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.session import working_folder

# Rows handled at once inside a task: with texts of 100 kB each, some 50 MB.
ROWS_AT_ONCE = 512


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for an intermediate result, below the shared one that the cluster names."""
    return f"{working_folder(spark).rstrip('/')}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and survives a lost executor."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, so many at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column as Python strings; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


# ASCII characters that are no part of a word become blanks.
_BLANKED = bytes(c if c >= 128 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
_ODD = re.compile(r"[^\w\x00-\x7f]")
_WORD = re.compile(r"\w+")


def lower_words(text: str) -> list[bytes]:
    """The words (``\\w+``) of a text in lower case, as UTF-8. Texts without odd characters are split bytewise, which is faster."""
    text = text.lower()
    if text.isascii() or not _ODD.search(text):
        return text.encode("utf-8", "surrogatepass").translate(_BLANKED).split()
    return [w.encode("utf-8", "surrogatepass") for w in _WORD.findall(text)]


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and all other letters as they are. Texts of ASCII alone take the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


# ASCII bytes other than letters and digits end a word; line feeds are kept apart so that lines can still be told.
_WORD_BYTES = bytes(c if c >= 128 or chr(c).isalnum() or c == 10 else 32 for c in range(256))
WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BYTES_A_CHUNK = 1 << 20


def plain_bytes(text: str) -> bytes:
    """A text as UTF-8 with A-Z in lower case and a blank for all that is neither a line feed nor part of a word ``WORD_SQL``."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_WORD_BYTES)


def word_chunks(plain: bytes, size: int = BYTES_A_CHUNK) -> Iterator[list[bytes]]:
    """The words of such bytes in lists of some ``size`` bytes each, so that a very long text is never one list."""
    start = 0
    while len(plain) - start > size:
        stop = start + size
        while stop < len(plain) and plain[stop] not in b" \n":
            stop += 1
        yield plain[start:stop].split()
        start = stop
    yield plain[start:].split()
