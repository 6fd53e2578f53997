"""Runs (maximal repetitions of words) by a dictionary of basic factors.

1. Dictionary. The basic factors of a text are its stretches of 1, 2, 4, ... words. Those that occur more than once in the
   document get integer names: words by comparing them whole, longer ones as pairs of the names of their halves. A length
   at which no factor occurs twice is the last one, so most texts need only a few.
2. Proposals. Occurrences of one factor of length m at most m/2 apart are exactly its period apart, so they fall
   into arithmetic progressions (clusters) that are more than m/2 from each other. A run of period q is proposed at the
   one length with m <= q < 2m: it repeats a factor q words on, in one of the next three clusters. Either the first or
   the last members of both clusters are q apart, or the two stretches that the clusters lie in touch each other; then
   all differences between members, an arithmetic progression too, are proposed.
3. Extension. A proposal (place, period) is extended to both sides by comparing names from the longest factors down.
4. Runs reached from several proposals or with a multiple of their period are put together: of one stretch the smallest
   period counts.

Everything is done for many documents at once with arrays; a document is never split, so a task holds the words of a
piece of text (2 MB, or one longer document) and about a dozen numbers for each of its words and repeated factors.

Defined results: null and empty texts have no words and no runs; a null doc_id is kept; repeated rows give repeated
results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tenderline.llm.common import pieces, read_table, texts, words

MIN_WORDS = 12


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, equal exactly for equal words, and the distinct words."""
    lengths = ends - starts
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    inside = np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])
    buffers = [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(data[inside].tobytes())]
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


class Factors:
    """Names of the basic factors that occur more than once in their document; -1 for all others."""

    def __init__(self, codes: np.ndarray, row: np.ndarray):
        self.row, self.names = row, []
        n = len(codes)
        places = np.arange(n)
        first, second, m = row, codes, 1
        while True:
            key = first * (int(second.max(initial=0)) + 1) + second
            _, group, size = np.unique(key, return_inverse=True, return_counts=True)
            often = size > 1
            number = np.where(often, np.cumsum(often) - 1, -1)
            name = np.full(n, -1, np.int64)
            name[places] = number[group]
            places = places[number[group] >= 0]
            if not len(places):
                return
            self.names.append(name)
            places = places[places + m < n]
            # Names are kept apart by document from the first length on, so both halves lie in one document.
            places = places[name[places + m] >= 0]
            places = places[row[places] == row[places + m]]
            first, second, m = name[places], name[places + m], 2 * m

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` > a on, inside the document."""
        done, n = np.zeros(len(a), np.int64), len(self.row)
        for k in reversed(range(len(self.names))):
            at = b + done
            fits = np.flatnonzero(at < n)
            name = self.names[k]
            same = (name[a[fits] + done[fits]] == name[at[fits]]) & (name[at[fits]] >= 0)
            done[fits[same]] += 1 << k
        return done

    def back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those before ``b`` > a, inside the document."""
        done = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.names))):
            at = a - done - (1 << k)
            fits = np.flatnonzero(at >= 0)
            name = self.names[k]
            same = (name[at[fits]] == name[b[fits] - done[fits] - (1 << k)]) & (name[at[fits]] >= 0)
            done[fits[same]] += 1 << k
        return done

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, period) such that each run has one with its period and a place inside it."""
        found = []
        for k, name in enumerate(self.names):
            m = 1 << k
            places = np.flatnonzero(name >= 0)
            places = places[np.argsort(name[places], kind="stable")]
            own = name[places]
            new = np.ones(len(places), bool)
            new[1:] = (own[1:] != own[:-1]) | (2 * np.diff(places) > m)
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(places)) - 1
            first, last, own = places[heads], places[tails], own[heads]
            for t in (1, 2, 3):
                same = np.flatnonzero(own[t:] == own[:-t]) if len(own) > t else np.zeros(0, np.int64)
                for ends in (first, last):
                    found.append((ends[same], ends[same + t] - ends[same], m))
                if t == 1:
                    found += self._between(first, last, tails - heads + 1, same, m)
        kept = [(i[ok], d[ok]) for i, d, m in found for ok in [(d >= m) & (d < 2 * m)]]
        i, d = (np.concatenate([x[j] for x in kept] or [np.zeros(0, np.int64)]) for j in (0, 1))
        return i, d

    @staticmethod
    def _between(first, last, size, same, m):
        """All differences between a cluster and the next one, of clusters whose periodic stretches touch."""
        one, two = same, same + 1
        step = np.maximum(
            np.where(size[one] > 1, (last[one] - first[one]) // np.maximum(size[one] - 1, 1), 0),
            np.where(size[two] > 1, (last[two] - first[two]) // np.maximum(size[two] - 1, 1), 0),
        )
        keep = (step > 0) & (first[two] <= last[one] + m + 2 * step)
        one, two, step = one[keep], two[keep], step[keep]
        least = first[two] - last[one]
        # Differences least + t * step in [m, 2m), t below the sum of both sizes less one.
        low = np.maximum(-((least - m) // step), 0)
        high = np.minimum(size[one] + size[two] - 2, (2 * m - 1 - least) // step)
        count = np.maximum(high - low + 1, 0)
        at = np.repeat(np.arange(len(one)), count)
        t = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[at]
        back = np.maximum(t - (size[two][at] - 1), 0)
        return [(last[one][at] - back * step[at], least[at] + t * step[at], m)]


def runs_of(codes: np.ndarray, row: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in ``codes``), length and smallest period of all runs, by start, then period; ``row`` tells documents apart."""
    factors = Factors(codes, row)
    i, d = factors.proposals()
    start = i - factors.back(i, i + d)
    length = i + d + factors.ahead(i, i + d) - start
    good = length >= np.maximum(min_words, 2 * d)
    start, length, d = start[good], length[good], d[good]
    ranks = np.lexsort((d, length, start))
    start, length, d = start[ranks], length[ranks], d[ranks]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) > 0) | (np.diff(length) > 0)
    start, length, d = start[new], length[new], d[new]
    ranks = np.lexsort((d, start))
    return start[ranks], length[ranks], d[ranks]


def planted(ids: list, bounds: np.ndarray) -> np.ndarray:
    """For each word the word that stands in its place: in every tenth document a tail repeats its first words."""
    source = np.arange(bounds[-1])
    for k, doc_id in enumerate(ids):
        n = int(bounds[k + 1] - bounds[k])
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[bounds[k] + a : bounds[k + 1]] = bounds[k] + a + np.arange(n - a) % p
    return source


_RUNS = "doc_id long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"


def _found(batches: Iterator[pa.RecordBatch], min_words: int, plant: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for at, data, offsets in pieces(batch.column("text")):
            begin, end, row = words(data, offsets)
            size = len(offsets) - 1
            bounds = np.searchsorted(row, np.arange(size + 1))
            codes, distinct = word_codes(data, begin, end)
            if plant:
                codes = codes[planted(ids[at : at + size], bounds)]
            start, length, period = runs_of(codes, row, min_words)
            # Words that some run covers after its first period.
            edge = np.zeros(len(codes) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
            cuts = pa.array(np.searchsorted(kept, bounds))
            lists = pa.LargeListArray.from_arrays(cuts.cast(pa.int64()), pc.take(distinct, pa.array(codes[kept])).cast(pa.large_string()))
            joined = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
            cuts = pa.array(np.searchsorted(start, bounds).astype(np.int32))
            numbers = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (start - bounds[row[start]], length, period)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(at, size), *numbers, joined], ["doc_id", "starts", "lengths", "periods", "collapsed"]
            )


def runs(docs: DataFrame, min_words: int = MIN_WORDS, plant: bool = False) -> DataFrame:
    """doc_id, the runs of its words (starts, lengths, periods) and the text with every run cut to its first period.

    ``plant`` puts the contract's repetitions into every tenth document first.
    """
    return texts(docs).mapInArrow(lambda b: _found(b, min_words, plant), _RUNS)


_DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _DIGESTS.split(", ")]
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("starts", "lengths", "periods", "collapsed")]
        for starts, lengths, periods, collapsed in zip(*columns, strict=True):
            best = min(zip(starts, lengths, periods, strict=True), key=lambda r: (-r[1], r[0], r[2]), default=None)
            told = "".join(f"{s},{n},{q}\n" for s, n, q in zip(starts, lengths, periods, strict=True))
            top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            rows.append((len(starts), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (told, collapsed))))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], names
        )


def run_digests(docs: DataFrame, plant: bool = False) -> DataFrame:
    return runs(docs, plant=plant).mapInArrow(_digests, _DIGESTS)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return run_digests(read_table(spark, sf_dir, "documents"), plant=True)
