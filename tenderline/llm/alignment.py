"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked id pairs.

Both tokenizers split the same bytes, so a text falls apart at the offsets where tokens of both end; within a part (group)
every token of one is linked to every token of the other.

1. Survey. Tasks align their documents in blocks and give, per block, the distinct pairs with the number of documents that hold
   each linked, split into shards by a hash of the pair; beside them the groups of the block's documents, as numbers in a table
   of the distinct groups (kinds) of a piece, the frequent ones first, compressed.
2. Index. The distinct pairs of a shard get a minimal perfect hash (``lines.Shard``); the pair itself is stored at its number, so
   a lookup is verified exactly.
3. Counts. Blocks add their counts into dense vectors indexed by the hash, one for each shard and salt; the vectors of all salts
   are summed in a second step. The best count of an id is a maximum over the vectors, as many numbers as the vocabulary has ids.
4. Second pass. The pairs of a block are looked up in the vectors, the results meet the block's groups, every link of a kind
   gets its pair's count, and a document's figures are sums over the kinds of its groups. No text is encoded twice.

In 2 to 4 the rows that meet (an index and the blocks' pairs, a block's counts and its groups) are dealt by their key, sorted and read one
after the other, so a task holds one shard or one block at a time. Groups with very many links are counted by distinct ids.

Defined results: texts that are null, empty or whose tokens do not give back their bytes have no tokens (zeros, no groups); a null
doc_id is kept; rows with equal doc_id are documents of their own; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.llm.common import mixed, read_table, texts, written
from tenderline.llm.lines import Shard
from tenderline.llm.tokens import byte_level

# Bytes of text that are aligned at once, and that a block has at most (one longer text is a block by itself).
PIECE_BYTES = 512 << 10
BLOCK_BYTES = 4 << 20
# Distinct pairs of a block.
BLOCK_PAIRS = 1 << 20
# Tasks between which the pairs of a shard are dealt before their vectors are summed.
SALTS = 4
# Links of a group from which on its distinct ids are paired instead of its tokens.
MANY_LINKS = 4096


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of each piece: U+2581 stands for a space, <0xHH> for a byte."""
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        found.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return found


MARKS = b",|;"


@lru_cache(maxsize=4)
def _decimals(bits: int) -> pa.Array:
    """All numbers of so many bits as decimals, before each of the marks."""
    return pa.array([b"%d%c" % (n, mark) for mark in MARKS for n in range(1 << bits)], pa.large_binary())


@dataclass
class Alignment:
    """Tokens and groups of several documents, in their sequence; ``doc`` numbers the documents."""

    size: int
    ids_a: np.ndarray
    ids_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    doc: np.ndarray  # of each group

    def per_doc(self, values: np.ndarray, doc: np.ndarray) -> np.ndarray:
        found = np.zeros(self.size, np.int64)
        np.add.at(found, doc, values)
        return found

    def counts(self) -> tuple[np.ndarray, ...]:
        """n_a, n_b, n_groups and n_links by document."""
        a = np.bincount(self.group_a, minlength=len(self.doc))
        b = np.bincount(self.group_b, minlength=len(self.doc))
        return tuple(self.per_doc(x, self.doc) for x in (a, b, np.ones(len(a), np.int64), a * b))

    def links(self, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair (a * wide + b), document and number of all links; a pair may come several times."""
        n = len(self.doc)
        first_a, first_b = np.searchsorted(self.group_a, np.arange(n + 1)), np.searchsorted(self.group_b, np.arange(n + 1))
        size_a, size_b = np.diff(first_a), np.diff(first_b)
        many = size_a * size_b > MANY_LINKS
        each = np.where(many, 0, size_b)[self.group_a]
        total = int(each.sum())
        at = np.arange(total) + np.repeat(first_b[self.group_a] - (np.cumsum(each) - each), each)
        pairs = [np.repeat(self.ids_a, each) * wide + self.ids_b[at]]
        docs, times = [np.repeat(self.doc[self.group_a], each)], [np.ones(total, np.int64)]
        for g in np.flatnonzero(many).tolist():
            a, n_a = np.unique(self.ids_a[first_a[g] : first_a[g + 1]], return_counts=True)
            b, n_b = np.unique(self.ids_b[first_b[g] : first_b[g + 1]], return_counts=True)
            pairs.append((a[:, None] * wide + b).ravel())
            times.append((n_a[:, None] * n_b).ravel())
            docs.append(np.full(len(a) * len(b), self.doc[g]))
        return np.concatenate(pairs), np.concatenate(docs), np.concatenate(times)

    def told(self) -> list[bytes]:
        """The groups of each document as text: ids of A, a bar, ids of B; groups apart by semicolons."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        ids, mark = np.zeros(n_a + n_b, np.int64), np.zeros(n_a + n_b, np.int64)
        groups = np.arange(len(self.doc))
        until_a, until_b = np.searchsorted(self.group_a, groups, side="right"), np.searchsorted(self.group_b, groups, side="right")
        before_b = np.concatenate([[0], until_b[:-1]]) if len(groups) else until_b
        ids[np.arange(n_a) + before_b[self.group_a]] = self.ids_a
        ids[np.arange(n_b) + until_a[self.group_b]] = self.ids_b
        mark[until_a + before_b - 1], mark[until_a + until_b - 1] = MARKS.index(b"|"), MARKS.index(b";")
        bits = int(ids.max(initial=0)).bit_length()
        shown = pc.take(_decimals(bits), pa.array(ids + (mark << bits)))
        _, places, data = shown.buffers()
        places = np.frombuffer(places, np.int64, len(shown) + 1)
        last = np.searchsorted(self.doc, np.arange(self.size), side="right")
        ends = np.where(last > 0, (until_a + until_b)[last - 1] if len(groups) else 0, 0).tolist()
        ends = places[ends].tolist()
        return [data[a : b - 1].to_pybytes() if b > a else b"" for a, b in zip([0, *ends], ends)]

    def kinds(self) -> tuple[Alignment, np.ndarray]:
        """The distinct groups, frequent ones first and each as a document of its own, and the number of every group among them."""
        n = len(self.doc)
        if not n:
            return Alignment(0, self.ids_a, self.ids_b, self.group_a, self.group_b, self.doc), np.zeros(0, np.int64)
        sides = [(ids, group, np.searchsorted(group, np.arange(n + 1))) for ids, group in ((self.ids_a, self.group_a), (self.ids_b, self.group_b))]
        seed = 0
        while True:
            hashes = np.zeros(n, np.uint64)
            for ids, group, first in sides:
                placed = ids.astype(np.uint64) << np.uint64(32) | (np.arange(len(ids)) - first[group]).astype(np.uint64)
                seed += 1
                hashes = mixed(hashes + np.add.reduceat(mixed(placed + np.uint64(seed << 16)), first[:-1]))
            _, like, code, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            model = like[code]
            if all(_alike(ids, group, first, model) for ids, group, first in sides):
                break
        order = np.argsort(-times, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        found = []
        for ids, _, first in sides:
            size = np.diff(first)[like[order]]
            at = np.arange(size.sum()) + np.repeat(first[like[order]] - (np.cumsum(size) - size), size)
            found.append((ids[at], np.repeat(np.arange(len(size)), size)))
        (ids_a, group_a), (ids_b, group_b) = found
        return Alignment(len(order), ids_a, ids_b, group_a, group_b, np.arange(len(order))), number[code]


def _alike(ids: np.ndarray, group: np.ndarray, first: np.ndarray, model: np.ndarray) -> bool:
    """Whether each group has the ids of its model."""
    size = np.diff(first)
    if (size != size[model]).any():
        return False
    return bool((ids == ids[np.arange(len(ids)) + (first[model] - first[:-1])[group]]).all())


class Aligner:
    """Tokenizer A from a byte-level file (its text), tokenizer B from a model of pieces (its bytes)."""

    def __init__(self, spec: str, model: bytes):
        self.a = byte_level(spec, False)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_b = piece_bytes(self.b)
        self.lengths_b = np.array([len(x) for x in self.bytes_b])
        self.size_a = max(self.a.ranks.values()) + 1
        self.lengths_a = np.zeros(self.size_a, np.int64)
        for token, i in self.a.ranks.items():
            self.lengths_a[i] = len(token)
        self.wide = len(self.bytes_b)

    def align(self, rows: list[str | None]) -> Alignment:
        full = [k for k, text in enumerate(rows) if text]
        split_b = self.b.encode([rows[k] for k in full], num_threads=1)
        doc, ids_a, ids_b = [], [], []
        for k, ids in zip(full, split_b):
            raw = " " + rows[k]
            if b"".join(map(self.bytes_b.__getitem__, ids)) == raw.encode():
                doc.append(k)
                ids_a.append(self.a.encode(raw))
                ids_b.append(np.array(ids, np.int64))
        none = np.zeros(0, np.int64)
        sizes = [len(x) for x in ids_a]
        a, b = np.concatenate([none, *ids_a]).astype(np.int64), np.concatenate([none, *ids_b])
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        if not len(a):
            return Alignment(len(rows), none, none, none, none, none)
        at = np.searchsorted(ends_b, ends_a)
        cut_a = ends_b[np.minimum(at, len(b) - 1)] == ends_a
        cut_b = np.zeros(len(b), np.int64)
        cut_b[at[cut_a]] = 1
        own = np.repeat(np.array(doc), sizes)
        return Alignment(len(rows), a, b, np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b, own[cut_a])


@lru_cache(maxsize=2)
def aligner(spec: str, model: bytes) -> Aligner:
    return Aligner(spec, model)


def _packed(doc_ids: pa.Array, sizes: np.ndarray, kinds: Alignment, code: np.ndarray) -> bytes:
    """Documents with their number of groups, the kinds of a piece and the kind of each group, by bytes of one weight."""
    planes = code.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()
    columns = [doc_ids, *(pa.array(x) for x in (sizes, kinds.ids_a, kinds.ids_b, kinds.group_a, kinds.group_b, planes))]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in columns]
    batch = pa.RecordBatch.from_arrays(lists, [str(k) for k in range(len(lists))])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(blob: bytes) -> tuple[pa.Array, np.ndarray, Alignment, np.ndarray]:
    (batch,) = pa.ipc.open_stream(blob)
    doc_ids, *rest = (column.flatten() for column in batch.columns)
    sizes, ids_a, ids_b, group_a, group_b, planes = (x.to_numpy() for x in rest)
    code = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    n = int(group_a.max(initial=-1)) + 1
    return doc_ids, sizes, Alignment(n, ids_a, ids_b, group_a, group_b, np.arange(n)), code


def _joined(kinds: Alignment, code: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The text of each document's groups, which end at ``ends``."""
    shown = pc.take(pa.array([x + b";" for x in kinds.told()], pa.large_binary()), pa.array(code))
    _, places, data = shown.buffers()
    places = np.frombuffer(places, np.int64, len(shown) + 1)[ends].tolist() if len(shown) else [0] * len(ends)
    return [data[a : b - 1].to_pybytes() if b > a else b"" for a, b in zip([0, *places], places)]


def _cuts(rows: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(from, to, bytes) of consecutive rows with about PIECE_BYTES."""
    sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in rows]
    begin, total = 0, 0
    for k, n in enumerate(sizes):
        if k > begin and total + n > PIECE_BYTES:
            yield begin, k, total
            begin, total = k, 0
        total += n
    if len(sizes) > begin:
        yield begin, len(sizes), total


class _Sums:
    """Counts by key, added up in bounded portions."""

    def __init__(self):
        self.keys, self.counts, self.waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        if sum(len(k) for k, _ in self.waiting) > max(len(self.keys), 1 << 18):
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting = []
        ranks = np.argsort(keys, kind="stable")
        keys, counts = keys[ranks], counts[ranks]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


_SURVEY = "block long, shard int, keys binary, counts binary, groups binary"
_SURVEY_NAMES = [f.split()[0] for f in _SURVEY.split(", ")]
_SURVEY_ARROW = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("groups", pa.binary())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_SURVEY_ARROW)], schema=_SURVEY_ARROW)


def _held(doc: np.ndarray, kinds: Alignment, code: np.ndarray, wide: int) -> np.ndarray:
    """The linked pairs of each document, once for each."""
    n = kinds.size
    pairs, kind, _ = kinds.links(wide)
    ranks = np.lexsort((pairs, kind))
    pairs, kind = pairs[ranks], kind[ranks]
    new = np.append(True, (pairs[1:] != pairs[:-1]) | (kind[1:] != kind[:-1]))[: len(kind)]
    pairs, first = pairs[new], np.searchsorted(kind[new], np.arange(n + 1))
    doc, kind = np.divmod(np.unique(doc * n + code), max(n, 1))
    each = np.diff(first)[kind]
    at = np.arange(each.sum()) + np.repeat(first[kind] - (np.cumsum(each) - each), each)
    return np.unique(np.repeat(doc, each) << 40 | pairs[at]) & (1 << 40) - 1


def _survey(batches: Iterator[pa.RecordBatch], sent, shards: int) -> Iterator[pa.RecordBatch]:
    one, block, sums, size = aligner(*sent.value), TaskContext.get().partitionId() << 32, _Sums(), 0

    def closed() -> pa.RecordBatch:
        sums.settle()
        home = shard_of(sums.keys, shards)
        ranks = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[ranks], np.arange(shards + 1))
        rows = []
        for s in range(shards):
            own = ranks[cuts[s] : cuts[s + 1]]
            if len(own):
                rows.append((block, s, sums.keys[own].tobytes(), sums.counts[own].tobytes(), None))
        return _rows(rows)

    for batch in batches:
        ids, rows = batch.column("doc_id"), batch.column("text")
        for a, b, n in _cuts(rows):
            if size and (size + n > BLOCK_BYTES or len(sums.keys) > BLOCK_PAIRS):
                yield closed()
                block, sums, size = block + 1, _Sums(), 0
            size += n
            part = rows.slice(a, b - a).to_pylist()
            found = one.align(part)
            kinds, code = found.kinds()
            pairs = _held(found.doc, kinds, code, one.wide)
            sums.add(pairs, np.ones(len(pairs), np.int64))
            sizes = np.bincount(found.doc, minlength=len(part))
            yield _rows([(block, None, None, None, _packed(ids.slice(a, b - a), sizes, kinds, code))])
    yield closed()


def _numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int64)


_INDEX = "shard int, sizes binary, bits binary, pairs binary, totals binary"
_INDEX_NAMES = [f.split()[0] for f in _INDEX.split(", ")]


def _index_row(shard: int, made: Shard, totals: np.ndarray) -> pa.RecordBatch:
    blobs = (made.sizes, made.bits, made.prints.astype(np.int64), totals)
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)], _INDEX_NAMES)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The minimal perfect hash of every shard's distinct pairs; its rows come one after the other."""
    shard, known = None, _Sums()

    def made() -> pa.RecordBatch:
        known.settle()
        keys = known.keys.astype(np.uint64)
        return _index_row(shard, Shard.build(mixed(keys), keys, np.zeros(len(keys), np.int64)), np.zeros(0, np.int64))

    for batch in batches:
        for own, blob in zip(batch.column("shard").to_pylist(), batch.column("keys").to_pylist(), strict=True):
            if own != shard:
                if shard is not None:
                    yield made()
                shard, known = own, _Sums()
            keys = _numbers(blob)
            known.add(keys, np.ones(len(keys), np.int64))
    if shard is not None:
        yield made()


def _read(row: dict) -> Shard:
    shard = Shard(_numbers(row["sizes"]), np.frombuffer(row["bits"], np.uint8), _numbers(row["pairs"]).astype(np.uint64), _numbers(row["totals"]))
    shard.index()
    return shard


def _placed(shard: Shard, keys: np.ndarray) -> np.ndarray:
    """The number of each pair, all of which are in the index."""
    found = shard.find(mixed(keys.astype(np.uint64)), keys.astype(np.uint64))
    if (found < 0).any() or (shard.prints[found] != keys.astype(np.uint64)).any():
        raise ValueError("a pair is missing from its shard")
    return found


_MET = f"{_INDEX}, block long, keys binary, counts binary"


def _beside(index: DataFrame, pairs: DataFrame, salt: Column | None) -> DataFrame:
    """Each shard's index and after it the blocks' pairs of the shard, both dealt by shard and salt."""
    session = index.sparkSession
    one = index.withColumn("block", F.lit(None).cast("long")).withColumn("keys", F.lit(None).cast("binary")).withColumn("counts", F.lit(None).cast("binary"))
    two = pairs.select("shard", *[F.lit(None).cast("binary").alias(c) for c in _INDEX_NAMES[1:]], "block", "keys", "counts")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))) if salt is not None else F.lit(0)
    both = one.withColumn("salt", salts).unionByName(two.withColumn("salt", salt if salt is not None else F.lit(0)))
    n = int(session.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(n, "shard", "salt").sortWithinPartitions("shard", "salt", F.col("keys").isNotNull()).drop("salt")


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A dense vector of counts for each shard that comes by, in the numbers of its hash."""
    shard, index, vector = None, None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([vector.tobytes()], pa.binary())], ["shard", "vector"])
    for batch in batches:
        for row in batch.to_pylist():
            if row["keys"] is None:
                if shard is not None:
                    yield out()
                shard, index = row["shard"], _read(row)
                vector = np.zeros(len(index.prints), np.int64)
            else:
                vector[_placed(index, _numbers(row["keys"]))] += _numbers(row["counts"])
    if shard is not None:
        yield out()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index of a shard with the sum of its vectors."""
    row, total = None, None
    for batch in batches:
        for met in batch.to_pylist():
            if met["keys"] is None:
                if row is not None:
                    yield _index_row(row["shard"], _read(row), total)
                row, total = met, np.zeros(len(met["pairs"]) // 8, np.int64)
            else:
                total = total + _numbers(met["keys"])
    if row is not None:
        yield _index_row(row["shard"], _read(row), total)


def _best(batches: Iterator[pa.RecordBatch], wide: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, totals in zip(batch.column("pairs").to_pylist(), batch.column("totals").to_pylist(), strict=True):
            a, counts = _numbers(pairs) // wide, _numbers(totals)
            most = np.zeros(int(a.max(initial=-1)) + 1, np.int64)
            np.maximum.at(most, a, counts)
            own = np.flatnonzero(most)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(most[own])], ["a", "most"])


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each block with their counts over all documents."""
    index = None
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["keys"] is None:
                index = _read(row)
            else:
                keys = _numbers(row["keys"])
                rows.append((row["block"], row["shard"], row["keys"], index.counts[_placed(index, keys)].tobytes(), None))
        yield _rows(rows)


_FOUND = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
)


def _resolved(batches: Iterator[pa.RecordBatch], wide: int, most, with_text: bool) -> Iterator[pa.RecordBatch]:
    """The figures of documents from their groups, after the counts of their block have come by."""
    best = most.value
    names = [f.split()[0] for f in _FOUND.split(", ")]
    block, known = None, _Sums()
    for batch in batches:
        for own, keys, counts, blob in zip(*(batch.column(c).to_pylist() for c in ("block", "keys", "counts", "groups")), strict=True):
            if own != block:
                block, known = own, _Sums()
            if blob is None:
                known.add(_numbers(keys), _numbers(counts))
                continue
            if known.waiting:
                known.settle()
            doc_ids, sizes, kinds, code = _opened(blob)
            pairs, kind, times = kinds.links(wide)
            counts = known.counts[np.searchsorted(known.keys, pairs)]
            n_a, n_b, _, n_links = kinds.counts()
            n_best = kinds.per_doc(np.where(counts == best[pairs // wide], times, 0), kind)
            ends = np.cumsum(sizes)
            own = (np.concatenate([[0], np.cumsum(x[code])]) for x in (n_a, n_b, n_links, n_best, kinds.per_doc(counts * times, kind)))
            n_a, n_b, *rest = (x[ends] - x[ends - sizes] for x in own)
            told = _joined(kinds, code, ends)
            digests = [hashlib.sha256(x).hexdigest() if x else "" for x in told]
            shown = [x.decode() for x in told] if with_text else [None] * len(told)
            numbers = [pa.array(x, pa.int64()) for x in (n_a, n_b, sizes, *rest)]
            yield pa.RecordBatch.from_arrays([doc_ids, *numbers, pa.array(digests, pa.string()), pa.array(shown, pa.string())], names)


def aligned(docs: DataFrame, path_a: str, path_b: str, with_text: bool = False) -> DataFrame:
    """Per document: tokens, groups, links, links of the best pair of their id, the sum of counts, the groups (text on request)."""
    rows = texts(docs)
    session = rows.sparkSession
    n = int(session.conf.get("spark.sql.shuffle.partitions"))
    with open(path_a, encoding="utf-8") as spec, open(path_b, "rb") as model:
        files = spec.read(), model.read()
    sent, wide = session.sparkContext.broadcast(files), aligner(*files).wide
    surveyed = written(rows.mapInArrow(lambda b: _survey(b, sent, n), _SURVEY), "survey")
    pairs = surveyed.where("shard IS NOT NULL").select("block", "shard", "keys", "counts")
    salt = F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int")
    keys = pairs.select("shard", "keys").repartition(n, "shard").sortWithinPartitions("shard")
    index = written(keys.mapInArrow(_indexed, _INDEX), "pair-index")
    vectors = _beside(index, pairs, salt).mapInArrow(_added, "shard int, vector binary")
    vectors = vectors.select(F.lit(None).cast("long").alias("block"), "shard", F.col("vector").alias("keys"), F.lit(None).cast("binary").alias("counts"))
    counted = written(_beside(index, vectors, None).mapInArrow(_summed, _INDEX), "pair-counts")
    # At most as many rows as the vocabulary has ids.
    most = np.zeros(aligner(*files).size_a, np.int64)
    for row in counted.mapInArrow(lambda b: _best(b, wide), "a long, most long").groupBy("a").agg(F.max("most").alias("most")).collect():
        most[row["a"]] = row["most"]
    told = session.sparkContext.broadcast(most)
    looked = _beside(counted, pairs, salt).mapInArrow(_looked_up, _SURVEY)
    both = looked.unionByName(surveyed.where("groups IS NOT NULL"))
    dealt = both.repartition(n, "block").sortWithinPartitions("block", F.col("groups").isNotNull())
    found = dealt.mapInArrow(lambda b: _resolved(b, wide, told, with_text), _FOUND)
    return found if with_text else found.drop("groups")


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return aligned(read_table(spark, sf_dir, "documents"), *paths)
