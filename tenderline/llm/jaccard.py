"""Exact set-similarity join on word shingles, with skipped lists and answers taken over from similar sets.

Index. Equal sets are one class. A set's shingles are ranked from rare to frequent (counts of all documents in a sketch of
fixed size: what many documents share stands out from its noise at any size of the input; any ranking would give the same
links) and its first |s| - ceil(t |s|) + 1 shingles go to the index lists, with the set's size and the shingle's
position. Two sets that are similar to t or more meet in a list.

Skipping by position. Sets that meet at positions p and q share at most min(p, q) shingles before and
min(|x| - p, |y| - q) from there on; pairs whose bound is too small, sizes included, are never looked at.

Parities. Each set has an array of bits, a 32nd of its size: the parity of the number of shingles in each slot. Where the
arrays of two sets differ, their shingles differ, so most pairs are ruled out exactly before a set is moved.

Answers from similar sets. A list is not expanded into pairs. Its first member by position is the hub, and the others
are compared with the hub only:

* similar to t: linked to the hub; two such sets are in one component whatever they have in common.
* below t, but above t' = 1 - 2 (1 - t): a link to any other set near the hub is derived from the differences from
  the hub. If x and y differ from the hub in no common shingle, they are less similar to each other than to the hub. So
  only sets that share a differing shingle are met, through the rarest differing shingles, and the size of their
  intersection follows from the hub's: |h| - |h-x| - |h-y| + |shared differences|. Texts are not compared again.
* below t': cannot be linked to what is linked to the hub. If at most ``SHORT_LIST`` such free sets are left, each is
  compared with the list's rest (a bounded multiple of the entries); else the rest goes through another round with
  HUB_GROWTH times as many hubs, free sets first, each laid against all that come after it. So a list takes a logarithmic
  number of rounds, also if no two of its sets are similar.

No link between different sets is lost as far as components go, and no list, however long, is squared.

Defined results: a text without words has size 0 and its own component; null text is empty; rows with equal doc_id
count as one document with several texts; a null doc_id is not linked; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderline.llm.common import pieces, read_table, shingled, texts, word_hashes, written
from tenderline.llm.components import components

SKETCH_BITS = 18
SKETCH_PART = 1 << 10
SHORT_LIST = 128
# Hubs of a list in each round, as a multiple of those in the round before.
HUB_GROWTH = 4
# Pairs of ids that are broadcast at most (16 MB); more are joined by a shuffle.
SENT_PAIRS = 1_000_000


def sets_of(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, data, offsets in pieces(column):
        hashes, bounds = word_hashes(data, offsets)
        for k in range(len(offsets) - 1):
            own = hashes[bounds[k] : bounds[k + 1]]
            if 0 < len(own) < words:
                yield shingled(own, len(own)) + np.uint64(len(own))
            else:
                yield np.unique(shingled(own, words))


def _slots(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << SKETCH_BITS) - 1)
    first = (shingles & low).astype(np.int64)
    return first, ((shingles >> np.uint64(SKETCH_BITS)) & low).astype(np.int64) + (1 << SKETCH_BITS)


_PROFILE = "doc_id long, n long, d1 long, d2 long, part int, counts binary"


def _profiled(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row by document (size and digest of its set); at the end the task's counts, in parts."""
    counts = np.zeros(2 << SKETCH_BITS, np.int64)
    names = [f.split()[0] for f in _PROFILE.split(", ")]
    for batch in batches:
        rows = []
        for found in sets_of(batch.column("text"), words):
            for slots in _slots(found):
                np.add.at(counts, slots, 1)
            rows.append((len(found), *np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64).tolist()))
        n, d1, d2 = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, d1, d2)), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())],
            names,
        )
    if counts.any():
        parts = counts.reshape(-1, SKETCH_PART)
        none = [pa.nulls(len(parts), pa.int64())] * 4
        blobs = pa.array([x.astype("<u4").tobytes() for x in parts], pa.binary())
        yield pa.RecordBatch.from_arrays([*none, pa.array(np.arange(len(parts), dtype=np.int32)), blobs], names)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            sums[part] = sums.get(part, 0) + np.frombuffer(blob, "<u4").astype(np.int64)
    rows = list(sums.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in rows], pa.int32()), pa.array([c.tobytes() for _, c in rows], pa.binary())], ["part", "counts"]
    )


def sketch_of(profile: DataFrame) -> np.ndarray:
    """The counts of all tasks: a fixed number of slots, whatever the input."""
    parts = profile.where("part IS NOT NULL").select("part", "counts")
    total = np.zeros((2 << SKETCH_BITS) // SKETCH_PART * SKETCH_PART, np.int64).reshape(-1, SKETCH_PART)
    for row in parts.repartition("part").mapInArrow(_summed, "part int, counts binary").collect():
        total[row["part"]] += np.frombuffer(row["counts"], np.int64)
    return total.ravel()


def _prefixes(batches: Iterator[pa.RecordBatch], sent, words: int, percent: int) -> Iterator[pa.RecordBatch]:
    counts = sent.value
    for batch in batches:
        sizes, kept, bits = [], [], []
        for found in sets_of(batch.column("text"), words):
            n = len(found)
            one, two = _slots(found)
            ranks = np.lexsort((found, np.minimum(counts[one], counts[two])))
            sizes.append(n)
            kept.append(found[ranks[: n + percent * -n // 100 + 1 if n else 0]].astype(np.int64))
            bits.append(parities(found))
        bounds = np.cumsum([0, *map(len, kept)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.zeros(0, np.int64), *kept])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), lists, pa.array(bits, pa.binary())], ["doc_id", "n", "prefix", "bits"]
        )


def parities(found: np.ndarray) -> bytes:
    """For each of at least twice as many slots as shingles whether an odd number of them falls into it."""
    size = 1 << max((2 * len(found) - 1).bit_length(), 8)
    slots = np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits(slots & 1 == 1, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """How many shingles are in one of two sets alone, from below: slots of different parity, the longer array folded."""
    one, two = (np.frombuffer(x, np.uint8) for x in ((a, b) if len(a) >= len(b) else (b, a)))
    while len(one) > len(two):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


def _plausible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose parities leave room for a similarity of ``percent``: of n + m shingles at most (100 - t) / (100 + t) differ."""
    for batch in batches:
        x, y, n, m = (batch.column(c).to_numpy() for c in ("x", "y", "n", "m"))
        least = map(least_difference, batch.column("bx").to_pylist(), batch.column("by").to_pylist())
        keep = np.fromiter(least, np.int64, len(x)) * (100 + percent) <= (100 - percent) * (n + m)
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(y[keep])], ["x", "y"])


def plausible(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that may be similar to ``percent`` by their parity arrays, a small part of the sets' size; none that is goes."""
    of = lambda side, size: arrays.select(F.col("doc_id").alias(side), F.col("n").alias(size), F.col("bits").alias(f"b{side}"))
    met = pairs.join(of("y", "m"), "y").join(of("x", "n"), "x")
    return met.select("x", "y", "n", "m", "bx", "by").mapInArrow(lambda b: _plausible(b, percent), "x long, y long").distinct()


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [x.astype(np.int64) for x in sets_of(batch.column("text"), words)]
        bounds = np.cumsum([0, *map(len, kept)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.zeros(0, np.int64), *kept])))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "set"])


def _may_reach(percent: int, n: str, p: str, m: str, q: str) -> Column:
    """Whether sets of sizes n, m that meet at positions p, q can be similar to ``percent``."""
    most = F.least(F.col(p), F.col(q)) + F.least(F.col(n) - F.col(p), F.col(m) - F.col(q))
    return (100 + percent) * most >= percent * (F.col(n) + F.col(m))


def compared(pairs: DataFrame, rows: DataFrame, words: int, percent: int, differences: bool) -> DataFrame:
    """Of distinct pairs (x, y), a written table: those similar to ``percent``, with sizes and intersection, and on request what differs."""
    # Up to so many pairs, their ids are small enough to go to all tasks, and texts stay where they are read.
    sent = F.broadcast if pairs.count() <= SENT_PAIRS else lambda df: df

    def of(side: str) -> DataFrame:
        ids = pairs.select(F.col(side).alias("doc_id")).distinct()
        sets = rows.join(sent(ids), "doc_id", "left_semi").mapInArrow(lambda b: _sets(b, words), "doc_id long, set array<long>")
        return sets.select(F.col("doc_id").alias(side), F.col("set").alias(f"s{side}"))

    both = of("y").join(sent(pairs), "y").join(of("x"), "x").select(
        "x", "y", F.size("sx").alias("nx"), F.size("sy").alias("ny"), F.size(F.array_intersect("sx", "sy")).alias("both"), "sx", "sy"
    )
    near = both.where(100 * F.col("both") >= percent * (F.col("nx") + F.col("ny") - F.col("both")))
    out = ["x", "y", "nx", "ny", "both"]
    if differences:
        out.append(F.concat(F.array_except("sx", "sy"), F.array_except("sy", "sx")).alias("differing"))
    return near.select(*out)


def _linked(percent: int) -> Column:
    return 100 * F.col("both") >= percent * (F.col("nx") + F.col("ny") - F.col("both"))


def derived_links(near: DataFrame, percent: int) -> DataFrame:
    """Links between sets near one hub x of which at least one is not linked to it, from the differences alone.

    With c = (100 |h-y| + t |y-h|) / (100 + t) (t in percent), y is linked to h if c <= b = (100 - t) |h| / (100 + t), and y, z
    are linked if they share s >= c(y) + c(z) - b differing shingles. If z is not linked to h, s > c(y) follows, and for
    such z itself s (100 - t) / 100... is at least what is missing to the hub; the prefixes below use both bounds.
    """
    hubs = near.where(~_linked(percent)).select("x").distinct()
    own = written(near.join(hubs, "x", "left_semi"), "near")
    lost, new = F.col("nx") - F.col("both"), F.col("ny") - F.col("both")
    cost = 100 * lost + percent * new  # c and b times (100 + t), whole numbers
    bound = (100 - percent) * F.col("nx")
    size = F.size("differing")
    # Shared shingles needed at least: against an unlinked partner more than c; for an unlinked set against any partner
    # z, whose c is at least t/(100+t) of what is shared: s (1 - t/(100+t)) >= c - b.
    beside = F.floor(cost / (100 + percent)) + 1
    alone = F.greatest(F.ceil((cost - bound) / 100), F.lit(1))
    told = own.select(
        "x", "y", "nx", (cost > bound).alias("open"), cost.alias("cost"),
        F.greatest(size - beside + 1, F.lit(0)).alias("half"), F.greatest(size - alone + 1, F.lit(0)).alias("long"), "differing",
    )
    spread = told.select("x", "y", "open", "half", "long", F.explode("differing").alias("e"))
    often = spread.groupBy("x", "e").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    rare = spread.join(often, ["x", "e"]).withColumn(
        "nth", F.row_number().over(Window.partitionBy("x", "y").orderBy("often", "e"))
    )
    # Shingles of one set alone come first in the ranking and meet nobody: they only use up the prefix.
    single = told.join(rare.groupBy("x", "y").agg(F.count(F.lit(1)).alias("common")), ["x", "y"]).select(
        "x", "y", (F.size("differing") - F.col("common")).alias("alone")
    )
    placed = rare.join(single, ["x", "y"]).withColumn("nth", F.col("nth") + F.col("alone"))
    any_side = placed.where("nth <= half").select("x", "e", F.col("y").alias("z"))
    open_side = placed.where("open AND nth <= long").select("x", "e", "y")
    met = open_side.join(any_side, ["x", "e"]).where("y <> z").select("x", "y", "z").distinct()
    one = told.select("x", "y", "nx", F.col("cost").alias("cy"), F.col("differing").alias("dy"))
    two = told.select("x", F.col("y").alias("z"), F.col("cost").alias("cz"), F.col("differing").alias("dz"))
    shared = F.size(F.array_intersect("dy", "dz"))
    enough = (100 + percent) * shared >= F.col("cy") + F.col("cz") - (100 - percent) * F.col("nx")
    return met.join(one, ["x", "y"]).join(two, ["x", "z"]).where(enough).select(F.col("y").alias("a"), F.col("z").alias("b"))


def links(rows: DataFrame, profile: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between representatives that connect the same documents as all links do."""
    near_percent = max(2 * percent - 100, 1)
    sent = rows.sparkSession.sparkContext.broadcast(sketch_of(profile))
    prefixes = rows.mapInArrow(lambda b: _prefixes(b, sent, words, percent), "doc_id long, n long, prefix array<long>, bits binary")
    prefixes = written(prefixes.join(reps, "doc_id", "left_semi"), "prefixes")
    arrays = prefixes.select("doc_id", "n", "bits")
    entries = prefixes.select(
        F.col("doc_id").alias("y"), "n", F.posexplode("prefix").alias("p", "w")
    )
    first = Window.partitionBy("w").orderBy("p", "y")
    hub = F.first(F.struct(F.col("y").alias("x"), F.col("n").alias("m"), F.col("p").alias("q"))).over(first)
    members = entries.withColumn("hub", hub).where("hub.x <> y")
    members = members.select("w", "y", "n", "p", F.lit(None).cast("long").alias("g"), "hub.*")
    members = written(members, "lists")
    beside, hubs, found = members, 1, None
    while True:
        pairs = beside.where(_may_reach(near_percent, "n", "p", "m", "q")).select("x", "y").distinct()
        pairs = written(plausible(pairs, arrays, near_percent), "pairs")
        near = written(compared(pairs, rows, words, near_percent, True), "near")
        here = near.where(_linked(percent)).select(F.col("x").alias("a"), F.col("y").alias("b"))
        here = here.unionByName(derived_links(near, percent))
        # Sets near one hub are settled among themselves; ``g`` is that hub, one of them if there are several.
        told = near.select("x", "y", _linked(percent).alias("done"), F.col("x").alias("h"))
        if hubs == 1:
            far = members.join(told, ["x", "y"], "left")
        else:
            told = heads.join(told, "x").groupBy("w", "y").agg(F.max("done").alias("done"), F.min("h").alias("h"))
            far = ranked.where(F.col("nth") > hubs).join(told, ["w", "y"], "left")
        rest = far.where("done IS NULL OR NOT done").select("w", "y", "n", "p", F.coalesce("h", "g").alias("g"))
        sizes = rest.groupBy("w").agg(
            F.count(F.lit(1)).alias("size"), F.count_if(F.col("g").isNull()).alias("free"), F.min("g").alias("g0"), F.max("g").alias("g1")
        ).where("size > 1 AND (free > 0 OR g0 < g1)")
        # Few free sets: each against all others, a bounded number of pairs for each entry.
        few = F.when(F.coalesce(F.col("g0") == F.col("g1"), F.lit(True)), F.col("free")).otherwise(F.col("size")) <= SHORT_LIST
        mixed_hubs = F.coalesce(F.col("g0") < F.col("g1"), F.lit(False)).alias("mixed_hubs")
        rest = written(rest.join(sizes.select("w", few.alias("few"), mixed_hubs), "w"), "rest")
        short = rest.where("few")
        free = short.where("g IS NULL OR mixed_hubs").select("w", F.col("y").alias("x"), F.col("n").alias("m"), F.col("p").alias("q"), F.col("g").alias("gx"))
        apart = "x <> y AND (gx IS NULL OR g IS NULL OR gx <> g)"
        meet = short.join(free, "w").where(apart).where(_may_reach(percent, "n", "p", "m", "q"))
        meet = meet.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        pairs = written(plausible(meet.select("x", "y").distinct(), arrays, percent), "pairs")
        if not pairs.isEmpty():
            here = here.unionByName(compared(pairs, rows, words, percent, False).select(F.col("x").alias("a"), F.col("y").alias("b")))
        here = written(here.distinct(), "links")
        found = here if found is None else found.unionByName(here)
        # More hubs in each round: a list of sets that are far from each other takes a logarithmic number of rounds.
        hubs *= HUB_GROWTH
        again = Window.partitionBy("w").orderBy(F.col("g").isNotNull(), "p", "y")
        ranked = written(rest.where("NOT few").drop("few", "mixed_hubs").withColumn("nth", F.row_number().over(again)), "lists")
        if ranked.isEmpty():
            return found
        heads = ranked.where(F.col("nth") <= hubs).select("w", F.col("y").alias("x"), F.col("n").alias("m"), F.col("p").alias("q"), F.col("nth").alias("k"))
        beside = ranked.join(heads, "w").where("nth > k")


def similar_groups(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    rows = texts(docs)
    profile = written(rows.mapInArrow(lambda b: _profiled(b, words), _PROFILE), "profile")
    each = profile.where("part IS NULL").select("doc_id", "n", "d1", "d2")
    linkable = each.where("doc_id IS NOT NULL AND n > 0")
    classes = linkable.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    reps = classes.select(F.col("rep").alias("doc_id"))
    known = rows.where("doc_id IS NOT NULL")
    # Rows with one doc_id and several texts hold their classes together.
    twice = linkable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("doc_id")
    held = linkable.join(twice, "doc_id", "left_semi").join(classes, ["d1", "d2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = components(links(known, profile, reps, words, percent).unionByName(held), "a", "b")
    classed = classes.join(labels, classes.rep == labels.node, "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("component"))
    return each.join(classed, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.least(F.coalesce(own, "doc_id"), "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id leads its component; all their columns. Documents without words stay."""
    groups = similar_groups(docs, words, percent)
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_groups(read_table(spark, sf_dir, "documents"))
