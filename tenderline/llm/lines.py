"""Line deduplication: documents probe compact arrays behind a sharded minimal perfect hash.

1. Every document gives the hashes of its distinct line keys; Spark counts in how many documents each occurs.
2. The hashes that reach the limit go to shards by their leading bits. A task builds one shard: a minimal perfect hash
   (levels of bit arrays: a key that is alone on its bit gets that bit's rank, the others go on to the next level)
   that numbers the keys 0..n-1, an array of fingerprints and an array of counts in that numbering.
3. Documents look their lines up in the arrays; there is no join of lines. Shards are small (KEYS_PER_SHARD) and are
   sent to the tasks in groups of at most PASS_BYTES. One group is one pass over the documents; a larger index takes
   several passes, each of which marks more lines, so what is broadcast has a fixed bound at any size.

A key has a 64-bit hash that places it and a second 64-bit hash as fingerprint, so a line outside the index is not
taken for one inside. A document is one row, and counts once for a key whatever the number of its lines.

Defined results: null or empty text is one empty line; keys shorter than ``min_chars`` code points are never dropped;
rows with equal doc_id are different documents; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.llm.common import _IS_SPACE, _LOWER, SpanHash, mixed, pieces, read_table, texts, written

KEYS_PER_SHARD = 1 << 18
PASS_BYTES = 64 << 20
# The limits of the registered query.
MIN_DOCS = 10
MIN_CHARS = 1

_PLACE, _PRINT = SpanHash(2), SpanHash(3)


def line_hashes(data: np.ndarray, offsets: np.ndarray, min_chars: int):
    """Of all lines of all rows: place, fingerprint, whether the key is long enough; and each row's line bounds."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    row = np.sort(np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1]))
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[bounds[1:] - 1] = offsets[1:]
    solid = np.flatnonzero(~_IS_SPACE[data])
    near = np.searchsorted(solid, starts)
    far = np.searchsorted(solid, ends)
    full = far > near
    first, last = starts.copy(), starts.copy()
    first[full], last[full] = solid[near[full]], solid[far[full] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    low = _LOWER[data]
    long_enough = points[last] - points[first] >= max(min_chars, 0)
    return _PLACE(low, first, last), _PRINT(low, first, last), long_enough, bounds


def _lines_of(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, offsets in pieces(batch.column("text")):
            place, mark, ok, bounds = line_hashes(data, offsets, min_chars)
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))[ok]
            keys = np.unique(np.rec.fromarrays([row, place[ok], mark[ok]], names="r,p,m"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.p.astype(np.int64)), pa.array(keys.m.astype(np.int64))], ["place", "mark"]
            )


def line_counts(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """place, mark and number of documents of every line key that reaches ``min_docs``."""
    found = docs.select("text").mapInArrow(lambda b: _lines_of(b, min_chars), "place long, mark long")
    return found.groupBy("place", "mark").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs)


@dataclass
class Shard:
    """Minimal perfect hash with its two arrays."""

    sizes: np.ndarray  # bits of each level
    bits: np.ndarray  # all levels, packed
    prints: np.ndarray
    counts: np.ndarray

    @staticmethod
    def _spots(keys: np.ndarray, prints: np.ndarray, level: int, size: int) -> np.ndarray:
        """Both hashes choose the bit, so keys with one place still part at some level."""
        turn = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (mixed(keys + turn ^ mixed(prints + turn)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> Shard:
        """From distinct (key, fingerprint) pairs."""
        rest, sizes, levels = np.arange(len(keys)), [], []
        while len(rest):
            size = max(64, 2 * len(rest) + 63 & ~63)
            spots = cls._spots(keys[rest], prints[rest], len(sizes), size)
            alone = np.bincount(spots, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            rest = rest[~alone[spots]]
        bits = np.packbits(np.concatenate([*levels, np.zeros(0, bool)]), bitorder="little")
        shard = cls(np.array(sizes, np.int64), bits, prints, counts)
        shard.index()
        where = shard.find(keys, prints)
        ranks = np.argsort(where, kind="stable")
        shard.prints, shard.counts = prints[ranks], counts[ranks]
        return shard

    def index(self) -> None:
        flags = np.unpackbits(self.bits, bitorder="little")
        self.ranks = np.concatenate([[0], np.cumsum(flags)]).astype(np.int32)
        self.flags = flags.astype(bool)

    def find(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where no level has it."""
        found = np.full(len(keys), -1, np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            spots = base + self._spots(keys[todo], prints[todo], level, size)
            hit = self.flags[spots]
            found[todo[hit]] = self.ranks[spots[hit]]
            todo, base = todo[~hit], base + size
        return found

    def counted(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """In how many documents each line occurs; 0 for a line outside the index."""
        found = self.find(keys, prints)
        known = np.flatnonzero(found >= 0)
        good = known[self.prints[found[known]] == prints[known]]
        counts = np.zeros(len(keys), np.int64)
        counts[good] = self.counts[found[good]]
        return counts


_SHARD = "shard long, sizes binary, bits binary, prints binary, counts binary"


def _build(shard: int, table: pa.Table) -> pa.Table:
    keys, marks = (table.column(c).to_numpy().astype(np.uint64) for c in ("place", "mark"))
    made = Shard.build(keys, marks, table.column("docs").to_numpy().astype(np.int64))
    blobs = [pa.array([x.tobytes()], pa.binary()) for x in (made.sizes, made.bits, made.prints, made.counts)]
    return pa.table([pa.array([shard]), *blobs], ["shard", "sizes", "bits", "prints", "counts"])


def _loaded(row) -> Shard:
    shard = Shard(
        np.frombuffer(row["sizes"], np.int64),
        np.frombuffer(row["bits"], np.uint8),
        np.frombuffer(row["prints"], np.uint64),
        np.frombuffer(row["counts"], np.int64),
    )
    shard.index()
    return shard


def line_index(counts: DataFrame) -> tuple[DataFrame, int]:
    """The shards as a table in the shared folder, and the number of leading bits that choose a shard."""
    counts = written(counts, "line-counts")
    n_bits = max((counts.count() // KEYS_PER_SHARD).bit_length(), 1)
    shard = F.shiftrightunsigned("place", 64 - n_bits).alias("shard")
    built = counts.select(shard, "place", "mark", "docs").groupBy("shard").applyInArrow(
        lambda key, table: _build(key[0].as_py(), table), _SHARD
    )
    return written(built, "line-index"), n_bits


def _groups(index: DataFrame) -> list[list[int]]:
    """Shards in groups of at most PASS_BYTES."""
    sizes = index.select("shard", sum(F.length(c) for c in ("bits", "prints", "counts")).alias("n")).orderBy("shard")
    groups, room = [], 0
    for row in sizes.collect():
        if row["n"] > room:
            groups.append([])
            room = PASS_BYTES
        groups[-1].append(row["shard"])
        room -= row["n"]
    return groups or [[]]


def _marked(batches: Iterator[pa.RecordBatch], sent, n_bits: int, min_docs: int, min_chars: int):
    shards = {row["shard"]: _loaded(row) for row in sent.value}
    for batch in batches:
        before, drops = batch.column("dropped").to_pylist(), []
        for _, data, offsets in pieces(batch.column("text")):
            place, mark, ok, bounds = line_hashes(data, offsets, min_chars)
            home = (place >> np.uint64(64 - n_bits)).astype(np.int64)
            drop = np.zeros(len(place), bool)
            for at, shard in shards.items():
                own = np.flatnonzero(ok & (home == at))
                drop[own] = shard.counted(place[own], mark[own]) >= min_docs
            hits = np.flatnonzero(drop)
            row = np.searchsorted(bounds, hits, side="right") - 1
            cut = np.searchsorted(row, np.arange(len(offsets)))
            drops += [(hits[cut[i] : cut[i + 1]] - bounds[i]).tolist() for i in range(len(offsets) - 1)]
        merged = pa.array([a + b for a, b in zip(before, drops, strict=True)], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), merged], schema=batch.schema)


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, kept = [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist(), strict=True):
            n_lines.append(text.count("\n") + 1)
            if gone:
                out = set(gone)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out)
            kept.append(text)
        n_dropped = pa.array([len(x) for x in batch.column("dropped").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_lines, pa.int64()), n_dropped, pa.array(kept, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "text"],
        )


def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text without the lines that ``min_docs`` documents share."""
    rows = texts(docs)
    spark = rows.sparkSession
    index, n_bits = line_index(line_counts(rows, min_docs, min_chars))
    state = rows.withColumn("dropped", F.array().cast("array<int>"))
    groups = _groups(index)
    for k, group in enumerate(groups):
        sent = spark.sparkContext.broadcast(index.where(F.col("shard").isin(group)).collect())
        state = state.mapInArrow(
            lambda b, sent=sent: _marked(b, sent, n_bits, min_docs, min_chars),
            "doc_id long, text string, dropped array<int>",
        )
        if k + 1 < len(groups):
            state = written(state, "line-marks")
    return state.mapInArrow(_rendered, "doc_id long, n_lines long, n_dropped long, text string")


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    found = drop_frequent_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT r, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
f AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
o AS (SELECT r, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM f)) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (k NOT IN (SELECT k FROM f)), '') AS kept
      FROM l GROUP BY r)
SELECT d.doc_id, o.n_lines, o.n_dropped, sha256(o.kept) AS kept_sha256 FROM o JOIN d USING (r)
"""
