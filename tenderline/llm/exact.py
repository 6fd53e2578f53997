"""Exact deduplication by deterministic block naming, in DataFrame functions only.

Texts (white-space runs made one space) are cut into fixed-size blocks. Equal blocks are sorted together and get one
integer name; adjacent names are paired and the pairs are named in the same way, level by level, until every document
has a single integer. Two documents have the same integer at the same level exactly if their texts are equal: names
come from comparing whole blocks and whole pairs, never from a hash.

The names of a level are written to the shared folder, so no level computes an earlier one again.

Hot blocks: a block that very many documents share is found from counts by hash and named from per-task minima; its rows
look the name up and move without the block, spread over all tasks. Every other block moves once.

Defined results: a null text is an empty text, an empty text is one empty block; a null doc_id counts as largest; of
rows with equal text and equal doc_id one stays; an empty table gives an empty result; other columns are not read.
``row`` ids follow the sequence in which the input's files are read, so pass a table that reads alike each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderline.llm.common import SPACE_CLASS, written

BLOCK_CHARS = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", " ")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def named(units: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``units`` with the integer ``name`` of their ``keys``: the smallest unit id among units with equal keys.

    ``rows`` is the number of documents. Keys that more than a quarter of a task's fair share of them have are hot.
    """
    n = _partitions(units)
    groups = units.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count(F.lit(1)).alias("k"))
    hot = [r["h"] for r in groups.where(F.col("k") > max(rows // (4 * n), 1)).orderBy(F.desc("k"), "h").limit(4 * n).collect()]
    if hot:
        # At most 4 n keys of one block each, so the lookup has a fixed bound; counted before the shuffle, by task.
        known = units.where(F.xxhash64(*keys).isin(hot)).groupBy(*keys).agg(F.min("unit").alias("hot_name"))
        units = units.join(F.broadcast(written(known, "hot-names")), keys, "left")
    else:
        units = units.withColumn("hot_name", F.lit(None).cast("long"))
    is_hot = F.col("hot_name").isNotNull()
    cold = units.select(
        *[c for c in units.columns if c not in keys],
        *[F.when(~is_hot, F.col(k)).alias(k) for k in keys],
        F.when(is_hot, F.pmod(F.xxhash64("unit"), F.lit(n))).otherwise(0).alias("salt"),
    )
    name = F.coalesce("hot_name", F.min("unit").over(Window.partitionBy(*keys, "salt")))
    return cold.withColumn("name", name).drop("hot_name", "salt", *keys)


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, row, text_sha256 and the identity (level, name) of every row."""
    longest, rows_in = docs.agg(F.max(F.length("text")), F.count(F.lit(1))).first()
    longest = longest or 1
    last = max(-(-longest // block_chars) - 1, 0)
    text = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "text", F.sha2("text", 256).alias("text_sha256")
    )
    starts = F.sequence(F.lit(0), F.greatest(F.length("text") - 1, F.lit(0)), F.lit(block_chars))
    units = rows.select(
        "doc_id",
        "row",
        "text_sha256",
        F.size(starts).alias("n"),
        F.posexplode(F.transform(starts, lambda s: F.substr("text", s + 1, F.lit(block_chars)))).alias("at", "block"),
    ).withColumn("unit", F.monotonically_increasing_id())
    open_ = written(named(units, ["block"], rows_in), "names")
    done = open_.where("n = 1").select("doc_id", "row", "text_sha256", F.lit(0).alias("level"), "name")
    for level in range(1, last.bit_length() + 1):
        name_at = lambda odd: F.min(F.when(F.col("at") % 2 == odd, F.col("name")))
        pairs = (
            open_.where("n > 1")
            .groupBy("doc_id", "row", "text_sha256", F.ceil(F.col("n") / 2).alias("n"), F.shiftright("at", 1).alias("at"))
            .agg(F.min("unit").alias("unit"), name_at(0).alias("left"), F.coalesce(name_at(1), F.lit(-1)).alias("right"))
        )
        open_ = written(named(pairs, ["left", "right"], rows_in), "names")
        closed = open_.where("n = 1").select("doc_id", "row", "text_sha256", F.lit(level).alias("level"), "name")
        done = done.unionByName(closed)
    return done


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    found = identities(docs, block_chars)
    groups = found.groupBy("level", "name").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("group_size"),
    )
    return found.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns, whatever their names; rows are told apart by doc_id and text."""
    kept = exact_groups(docs, block_chars).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")
    )
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"),
        F.col("doc_id").cast("long").alias("id"),
        F.sha2(normalised(F.col("text")), 256).alias("sha"),
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha"))
    once = Window.partitionBy("id", "sha").orderBy(F.col("own").getField("text"))
    first = whole.join(kept, same, "left_semi").withColumn("nth", F.row_number().over(once)).where("nth = 1")
    return first.select(*[F.col("own").getField(c).alias(c) for c in docs.columns])


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
