"""Packing of documents into sequences of a fixed window by minimum bin slack.

A document is its token ids and one closing id. Its full windows are sequences of their own; what remains, shorter
than a window, has to share one. A task takes the remainders of a block of documents (BLOCK_TOKENS) as counts by length and
fills window after window:

* The longest remaining length goes in first. A dynamic program over the counts (one bit of an integer for each sum; a
  length with a count of c is shifted in by powers of two up to c) gives the sums that the others reach, longest first
  and only until the window is full. The sum closest to the capacity is traced back to a count for each length, and this
  choice is used as often as the counts allow.
* If no choice fills the window, the longest length that is left is cut to fill it; its rest is a length like others. So a
  window has no slack while anything remains.
* The last tokens of a block, fewer than a window, become sequences with the power-of-two lengths that sum up to them,
  which need no padding.

The counts have one number for each length below the window, whatever the number of documents; blocks are packed where
their documents are encoded, so nothing is shuffled, collected or kept, and a lost task is simply run again.

Defined results: a null or empty text is the closing id alone; a null doc_id is kept; rows with equal doc_id are documents
of their own; an empty table gives no sequences; other columns are not read. ``sequence_id`` depends on the partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tenderline.llm.common import read_table, texts
from tenderline.llm.tokens import byte_level

WINDOW = 1024
CLOSING = 0
# Tokens of the documents that are packed together; a longer document is a block of its own.
BLOCK_TOKENS = 4 << 20
# Tokens of one Arrow batch; a longer document is one by itself.
BATCH_TOKENS = 1 << 18
# Sequences that one task can number.
TASK_SEQUENCES = 1 << 40


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Of lengths with counts the choice (length -> how often) whose sum is closest to ``room`` from below."""
    reached, steps, target = 1, [], 1 << room
    mask = (target << 1) - 1
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        steps.append((length, reached))
        left, part = min(counts[length], room // length), 1
        while left:
            part = min(part, left)
            reached |= reached << length * part & mask
            left, part = left - part, 2 * part
        if reached & target:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total, n = total - length, n + 1
        if n:
            chosen[length] = n
    return chosen


def filled(counts: dict[int, int], window: int = WINDOW) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(how often, [(length, length it is cut from)]) of all sequences made of ``counts``, which is used up.

    A piece that is cut keeps its beginning; its rest is from then on one of the remaining lengths.
    """
    counts = {length: n for length, n in counts.items() if n}

    def take(length: int, n: int) -> None:
        counts[length] -= n
        if not counts[length]:
            del counts[length]

    total = sum(length * n for length, n in counts.items())
    while total >= window:
        top = max(counts)
        others = dict(counts)
        others[top] -= 1
        chosen = best_fill({length: n for length, n in others.items() if n}, window - top)
        chosen[top] = chosen.get(top, 0) + 1
        slack = window - sum(length * n for length, n in chosen.items())
        times = min(counts[length] // n for length, n in chosen.items())
        pieces = [(length, length) for length, n in sorted(chosen.items(), reverse=True) for _ in range(n)]
        if slack:
            # Every length left is longer than the slack, or the choice would hold it too.
            rest = {length: n - times * chosen.get(length, 0) for length, n in counts.items()}
            while times > 1 and not any(n >= times for n in rest.values()):
                times //= 2
                rest = {length: n - times * chosen.get(length, 0) for length, n in counts.items()}
            longest = max(length for length, n in rest.items() if n >= times)
            pieces.append((slack, longest))
        for length, n in chosen.items():
            take(length, n * times)
        if slack:
            take(longest, times)
            counts[longest - slack] = counts.get(longest - slack, 0) + times
        total -= window * times
        yield times, pieces
    # Fewer tokens than a window: the bits of their number are lengths without padding.
    for bit in reversed(range(total.bit_length())):
        room, pieces = total & 1 << bit, []
        while room:
            top = max(counts)
            part = min(top, room)
            take(top, 1)
            if part < top:
                counts[top - part] = counts.get(top - part, 0) + 1
            pieces.append((part, top))
            room -= part
        if pieces:
            yield 1, pieces


def packed(sizes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """(document, start, length, sequence, offset) of every piece of documents of ``sizes`` tokens, by document and start."""
    whole, rest = np.divmod(sizes, window)
    doc = np.repeat(np.arange(len(sizes)), whole)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    rows = [np.column_stack([doc, nth * window, np.full(len(doc), window), np.arange(len(doc)), np.zeros(len(doc), np.int64)])]
    n = len(doc)
    # The remainders of each length, as stacks of (document, start).
    ranks = np.argsort(rest, kind="stable")
    lengths, first = np.unique(rest[ranks], return_index=True)
    stacks = {
        length: list(zip(own.tolist(), (whole[own] * window).tolist()))
        for length, own in zip(lengths.tolist(), np.split(ranks, first[1:]))
        if length
    }
    shared = []
    for times, pieces in filled({length: len(own) for length, own in stacks.items()}, window):
        for _ in range(times):
            offset = 0
            for length, source in pieces:
                document, start = stacks[source].pop()
                shared.append((document, start, length, n, offset))
                offset += length
                if length < source:
                    stacks.setdefault(source - length, []).append((document, start + length))
            n += 1
    rows.append(np.array(shared, np.int64).reshape(-1, 5))
    found = np.concatenate(rows)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, padded_length long, ids array<int>"
_NAMES = [f.split()[0] for f in _PIECES.split(", ")]


def _block(doc_ids: list, documents: list[np.ndarray], base: int, window: int) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(x) for x in documents], np.int64)
    found = packed(sizes, window)
    document, start, length, sequence, offset = found.T
    filled_to = np.bincount(sequence, length, minlength=int(sequence.max()) + 1).astype(np.int64)
    padded = np.where(filled_to & (filled_to - 1) == 0, filled_to, window)
    bounds = np.searchsorted(document, np.arange(len(sizes) + 1))
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH_TOKENS, side="right")), a + 1)
        part = slice(bounds[a], bounds[b])
        cuts = np.concatenate([[0], np.cumsum(length[part])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(documents[a:b]).astype(np.int32)))
        own = document[part]
        columns = [pa.array([doc_ids[k] for k in own.tolist()], pa.int64())]
        columns += [pa.array(x) for x in (start[part], length[part], sizes[own], base + sequence[part], offset[part], padded[sequence[part]])]
        yield pa.RecordBatch.from_arrays([*columns, ids], _NAMES)
        a = b


def _packs(batches: Iterator[pa.RecordBatch], sent, window: int, closing: int) -> Iterator[pa.RecordBatch]:
    coder, base = byte_level(sent.value, True), TaskContext.get().partitionId() * TASK_SEQUENCES
    doc_ids, documents, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            ids = np.append(coder.encode(text.as_py()), np.uint32(closing))
            if documents and size + len(ids) > BLOCK_TOKENS:
                yield from _block(doc_ids, documents, base, window)
                base += size // window + 64
                doc_ids, documents, size = [], [], 0
            doc_ids.append(doc_id)
            documents.append(ids)
            size += len(ids)
    if documents:
        yield from _block(doc_ids, documents, base, window)


def pack(docs: DataFrame, path: str, window: int = WINDOW, closing: int = CLOSING) -> DataFrame:
    """Every piece of every document: where it begins there, its ids, its sequence and its place in it.

    ``padded_length`` is the length that the sequence has with padding: its own at a power of two, else the window.
    """
    rows = texts(docs)
    with open(path, encoding="utf-8") as file:
        sent = rows.sparkSession.sparkContext.broadcast(file.read())
    return rows.mapInArrow(lambda b: _packs(b, sent, window, closing), _PIECES)


_CHECKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long"


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _CHECKED.split(", ")]
    for batch in batches:
        ids = batch.column("ids")
        values, cuts = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy().tolist()
        told = {n: batch.column(n) for n in _NAMES}
        told["ids_crc32"] = pa.array([zlib.crc32(values[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64())
        yield pa.RecordBatch.from_arrays([told[n] for n in names], names)


def op11_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.mapInArrow(_checked, _CHECKED)
