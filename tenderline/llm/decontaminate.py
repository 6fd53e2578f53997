"""Benchmark decontamination with spaced seeds.

1. Seeds. A mask looks at some of a few neighbouring words and ignores the others, so a replaced word at an ignored place
   leaves the hash as it is. ``MASKS`` together find every stretch of WINDOW words with at most two replaced words.
2. Filter. The seeds of the benchmark set bits in a table of fixed size; tasks test the seeds of every position of
   every document against it and keep the few positions that may hit, with the words around them.
3. Join. Kept seeds are joined with the benchmark's seeds by hash; a hit says which item lies there and how it is aligned.
4. Verification. Words are compared along the alignment. A document overlaps an item where, of WINDOW words in a row (all
   of a shorter item), at least SHARE are equal at their places; replaced words are tolerated, and hash hits by chance
   go.

Items of fewer than LEAST_WORDS words have one seed, of all their words, and count only where every word is equal. Items
with equal words are one item (the smallest item_id) while they are looked for; ``every_item`` gives the others back. The table of bits is the same size for any benchmark: a
larger one filters less, and what is joined stays exact. Nothing is collected but that table.

Defined results: null texts are empty and overlap nothing; items without words are not looked for;
a benchmark passage in repeated rows is found in each; null ids are kept as they are; empty tables give no overlaps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.llm.common import BATCH_ROWS, mixed, pieces, read_table, word_hashes, written

# Words looked at (1) and ignored (0).
MASKS = ("11111", "110111", "1101011", "1110011", "11001101", "10110011")
WINDOW = 13
SHARE = 0.8
LEAST_WORDS = 8
# Words kept on both sides of a position that may hit.
AROUND = 64
TABLE_BITS = 27


def seeds(hashes: np.ndarray, short: tuple[int, ...] = ()) -> list[tuple[int, np.ndarray]]:
    """(words it spans, hashes by position) of each mask over consecutive words, and of all ``short`` lengths of whole items."""
    found = []
    masks = [(k + 1, mask) for k, mask in enumerate(MASKS)] + [(64 + n, "1" * n) for n in short]
    for first, mask in masks:
        n = len(hashes) - len(mask) + 1
        total = np.full(max(n, 0), first, np.uint64)
        for at, looks in enumerate(mask):
            if looks == "1" and n > 0:
                total = (total ^ hashes[at : at + n]) * np.uint64(0x9FB21C651E98DF25)
                total ^= total >> np.uint64(32)
        found.append((len(mask), mixed(total)))
    return found


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << TABLE_BITS) - 1)
    return (keys & low).astype(np.int64), ((keys >> np.uint64(TABLE_BITS)) & low).astype(np.int64)


_ITEM = "item_id long, d string, tokens array<long>"


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens, marks = [], []
        for _, data, offsets in pieces(batch.column("text")):
            hashes, bounds = word_hashes(data, offsets)
            for k in range(len(offsets) - 1):
                own = hashes[bounds[k] : bounds[k + 1]]
                tokens.append(own.astype(np.int64).tolist())
                marks.append(hashlib.sha256(own.tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(marks, pa.string()), pa.array(tokens, pa.list_(pa.int64()))], ["item_id", "d", "tokens"]
        )


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id and word hashes of every distinct item with words."""
    return _hashed(benchmark).groupBy("d").agg(F.min("item_id").alias("item_id"), F.first("tokens").alias("tokens"))


def _hashed(benchmark: DataFrame) -> DataFrame:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_items, _ITEM).where(F.size("tokens") > 0)


def every_item(found: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows about an item, for each item with the same words."""
    each = _hashed(benchmark).select("d", F.col("item_id").alias("same_id")).distinct()
    least = each.groupBy("d").agg(F.min("same_id").alias("item_id"))
    named = found.join(least, found["item_id"].eqNullSafe(least["item_id"])).drop("item_id").join(each, "d")
    return named.withColumnRenamed("same_id", "item_id").drop("d")


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for mark, tokens in zip(batch.column("d").to_pylist(), batch.column("tokens")):
            own = tokens.values.to_numpy().astype(np.uint64)
            for _, keys in seeds(own)[: len(MASKS)] if len(own) >= LEAST_WORDS else seeds(own, (len(own),))[len(MASKS) :]:
                places = np.arange(len(keys), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int64)), pa.array([mark] * len(keys), pa.string()), pa.array(places)], ["key", "d", "place"]
                )


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bits in _bits(batch.column("key").to_numpy().astype(np.uint64)):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(bits))], ["bit"])


def bit_table(item_seeds: DataFrame) -> np.ndarray:
    """The bits that the benchmark's seeds set, packed: 2**TABLE_BITS of them at any size."""
    words = (
        item_seeds.select("key")
        .mapInArrow(_set_bits, "bit long")
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 AS int)))").alias("bits"))
    )
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    for batch in words.toArrow().to_batches():
        table[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    return table.view(np.uint64)


_REGION = "doc_id long, row_key long, start int, tokens array<long>, hits array<struct<key:bigint,place:int>>"
_REGION_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("row_key", pa.int64()), ("start", pa.int32()), ("tokens", pa.list_(pa.int64())),
     ("hits", pa.list_(pa.struct([("key", pa.int64()), ("place", pa.int32())])))]
)


def _regions(batches: Iterator[pa.RecordBatch], sent, short: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Stretches of documents around positions whose seed may be in the benchmark."""
    table = sent.value
    one = np.uint64(1)

    def is_set(bits: np.ndarray) -> np.ndarray:
        return (table[bits >> 6] >> (bits & 63).astype(np.uint64)) & one == one

    for batch in batches:
        rows: list[dict] = []
        ids, row_keys = batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist()
        for row, data, offsets in pieces(batch.column("text")):
            hashes, bounds = word_hashes(data, offsets)
            places, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for span, found in seeds(hashes, short):
                first, second = _bits(found)
                may = np.flatnonzero(is_set(first))
                may = may[is_set(second[may])]
                home = np.searchsorted(bounds, may, side="right")
                may = may[may + span <= bounds[home]]  # within one document
                places.append(may)
                keys.append(found[may])
            places, keys = np.concatenate(places), np.concatenate(keys)
            ranks = np.argsort(places, kind="stable")
            places, keys = places[ranks], keys[ranks]
            home = np.searchsorted(bounds, places, side="right") - 1
            new = np.ones(len(places), bool)
            new[1:] = (np.diff(places) > AROUND) | (np.diff(home) > 0)
            cuts = np.append(np.flatnonzero(new), len(places))
            for a, b in zip(cuts[:-1], cuts[1:]):
                doc = int(home[a])
                begin, end = max(bounds[doc], places[a] - AROUND), min(bounds[doc + 1], places[b - 1] + AROUND)
                hits = [{"key": x, "place": y} for x, y in zip(keys[a:b].astype(np.int64).tolist(), (places[a:b] - bounds[doc]).tolist())]
                rows.append(
                    {"doc_id": ids[row + doc], "row_key": row_keys[row + doc], "start": int(begin - bounds[doc]),
                     "tokens": hashes[begin:end].astype(np.int64).tolist(), "hits": hits}
                )
        yield pa.RecordBatch.from_pylist(rows, schema=_REGION_ARROW)


_OVERLAP = "doc_id long, row_key long, item_id long, first_word int, last_word int, n_equal int"


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where enough of WINDOW words in a row are equal along the alignment."""
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "row_key", "item_id", "start", "shift")]
        for *ids, start, shift, text, item in zip(*columns, batch.column("tokens"), batch.column("item_tokens")):
            text, item = text.values.to_numpy(), item.values.to_numpy()
            lead = shift - start  # where the item begins in the stretch
            a, b = max(0, -lead), min(len(item), len(text) - lead)
            width = min(WINDOW, len(item))
            if b - a < width:
                continue
            least = len(item) if len(item) < LEAST_WORDS else np.ceil(SHARE * width)
            equal = text[lead + a : lead + b] == item[a:b]
            sums = np.concatenate([[0], np.cumsum(equal)])
            good = np.flatnonzero(sums[width:] - sums[:-width] >= least)
            if len(good):
                first, last = int(good[0]), int(good[-1]) + width - 1
                rows.append((*ids, shift + a + first, shift + a + last, int(equal[first : last + 1].sum())))
        names = [f.split()[0] for f in _OVERLAP.split(", ")]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 3
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(6)], names)


def _keyed(docs: DataFrame) -> DataFrame:
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("row_key"), text.alias("text"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, row_key, item_id, first_word, last_word, n_equal of every overlap by alignment."""
    items = written(items_of(benchmark), "items")
    item_seeds = written(items.select("d", "tokens").mapInArrow(_item_seeds, "key long, d string, place int"), "seeds")
    sent = docs.sparkSession.sparkContext.broadcast(bit_table(item_seeds))
    # At most LEAST_WORDS - 1 lengths.
    lengths = items.where(F.size("tokens") < LEAST_WORDS).select(F.size("tokens").alias("n")).distinct().collect()
    short = tuple(sorted(r["n"] for r in lengths))
    regions = written(_keyed(docs).mapInArrow(lambda b: _regions(b, sent, short), _REGION), "regions")
    hits = regions.select("row_key", "start", F.explode("hits").alias("h")).select("row_key", "start", "h.key", F.col("h.place").alias("at"))
    aligned = (
        hits.distinct()
        .join(item_seeds, "key")
        .select("row_key", "start", "d", (F.col("at") - F.col("place")).alias("shift"))
        .distinct()
    )
    each = regions.select("doc_id", "row_key", "start", "tokens").dropDuplicates(["row_key", "start"])
    both = aligned.join(each, ["row_key", "start"]).join(items.withColumnRenamed("tokens", "item_tokens"), "d")
    return both.select("doc_id", "row_key", "item_id", "start", "shift", "tokens", "item_tokens").mapInArrow(_verified, _OVERLAP)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Of documents that overlap the benchmark: one row for each item, with the words from the first to the last overlap."""
    return overlaps(docs, benchmark).groupBy("doc_id", "row_key", "item_id").agg(
        F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.max("n_equal").alias("n_equal")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no item, all their columns, whatever their names."""
    bad = overlaps(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("row_key").alias("bad_key")).distinct()
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))).alias("key"),
    )
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("key") == F.col("bad_key"))
    clean = whole.join(bad, same, "left_anti")
    return clean.select(*[F.col("own").getField(c).alias(c) for c in docs.columns])


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    benchmark = read_table(spark, sf_dir, "benchmark")
    found = every_item(contaminated(read_table(spark, sf_dir, "documents"), benchmark), benchmark)
    return found.select("doc_id", "item_id", "first_word", "last_word", "n_equal").distinct()
