"""What several operators share: the shared scratch folder, Arrow batches in bounded pieces, word hashes."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one Arrow batch between the JVM and Python. Texts may be long, so a batch is kept short.
BATCH_ROWS = 256
# Bytes of text that a Python task works on at once; one longer text is a piece of its own.
PIECE_BYTES = 2 << 20

# The white space of the contracts.
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
SPACE_CLASS = "[\\x20\\x09-\\x0D]"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the data folder; the session is set to short Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that no other column can clash; a null text is empty."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only for a session in one process that names none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: later readers neither recompute nor lose them."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """As ``written``, for tables of one step: they are deleted when it is over."""
    folder = os.path.join(shared_folder(spark), f"step-{uuid.uuid4().hex}")

    def put(df: DataFrame, name: str) -> DataFrame:
        path = os.path.join(folder, f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield put
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# The low 0 to 8 bytes of a 64-bit number.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class SpanHash:
    """Hashes of many byte spans at once: eight bytes at a time through the finaliser, long spans by BLAKE2.

    Every step mixes all bits of what came before, so texts of one structure (repeated or complemented blocks) do not
    collide for every seed as they do under a polynomial modulo a power of two.
    """

    LONG = 256

    def __init__(self, seed: int = 0):
        self.seed = mixed(np.array([seed + 77], np.uint64))[0]

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = ends - starts
        room = np.zeros(len(data) + 8, np.uint8)
        room[: len(data)] = data
        eight = np.ndarray(len(data) + 1, "<u8", room, 0, (1,))  # the eight bytes from each place on
        seeds = mixed(np.arange(self.LONG + 2, dtype=np.uint64) + self.seed)
        found = seeds[np.minimum(lengths, self.LONG + 1)]
        # The first bytes of all at once: most spans have no more, and long ones get another hash below.
        if len(found):
            found ^= eight[starts] & _LOW_BYTES[np.minimum(lengths, 8)]
            found *= np.uint64(0x9FB21C651E98DF25)
            found += self.seed
            found = mixed(found)
            found[lengths == 0] = seeds[0]
        todo, at = np.flatnonzero((lengths > 8) & (lengths <= self.LONG)), 8
        while len(todo):
            left = lengths[todo] - at
            chunk = eight[starts[todo] + at] & _LOW_BYTES[np.minimum(left, 8)]
            found[todo] = mixed((found[todo] ^ chunk) * np.uint64(0x9FB21C651E98DF25) + self.seed)
            todo, at = todo[left > 8], at + 8
        key = int(self.seed).to_bytes(8, "little")
        for k in np.flatnonzero(lengths > self.LONG).tolist():
            digest = hashlib.blake2b(room[starts[k] : ends[k]], digest_size=8, key=key).digest()
            found[k] = int.from_bytes(digest, "little")
        return found


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of consecutive rows with about PIECE_BYTES of text."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        width = np.int32
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, width, len(column) + 1, column.offset * width().itemsize).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + PIECE_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, whole[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


_WORDS = SpanHash(1)


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words."""
    # SPACES, told without a table
    space = (data == 0x20) | (data - np.uint8(0x09) < 5)
    first, last = ~space, ~space
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    full = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] = ~space[heads]
    last[tails] = ~space[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (runs without SPACES; none crosses a row), and the row of each."""
    starts, ends = _spans(data, offsets)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    return data | ((data - np.uint8(0x41) < 26).view(np.uint8) << np.uint8(5))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the bounds of each row's words."""
    starts, ends = _spans(data, offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit hashes of some words of lower-cased text."""
    return _WORDS(low, starts, ends)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all words, A-Z lower-cased, and the bounds of each row's words."""
    low = lowered(data)
    starts, ends, bounds = word_spans(low, offsets)
    return span_hashes(low, starts, ends), bounds


def shingled(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n words; the words' sequence counts."""
    found = np.zeros(max(len(hashes) - n + 1, 0), np.uint64)
    for k in range(n):
        found ^= hashes[k : k + len(found)]
        found *= np.uint64(0x9FB21C651E98DF25)
        found ^= found >> np.uint64(29)
    return mixed(found)
