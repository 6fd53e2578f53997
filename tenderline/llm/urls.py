"""URL filter: rules by host and path, then the ratio of two character language models.

Urls that a rule decides are the training text: a fifth-degree Markov model of the accepted ones and one of the rejected
ones. A character's probability starts from the model of no context and is refined by each longer context that was
seen (Dirichlet smoothing), so rare contexts lean on shorter ones. The score is the difference of the log-likelihoods
divided by the number of characters, less the threshold at which the balanced error on the training urls is least;
it is found from a histogram of all their scores. Urls without a rule are allowed from 0 on.

Counts come from all decided urls, are summed by Spark and are exact: a character and the ORDER before it make a gram,
whose bytes fit into one long, so nothing is hashed. The table of grams grows with the urls and stays in Spark. Shorter
contexts are parts of a gram, so their counts are sums over that table, and all that scoring needs of a character is one
value by gram. The most frequent grams (at most HEAD) are broadcast; characters with another gram are joined to the table.

Defined results: a null url, or one without ``://``, has empty host and path, and the method judges the text there is;
a text without characters scores 0 (allow); with no accepted or no rejected urls every other url is allowed; repeated
rows are judged each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderline.llm.common import pieces, read_table, written

ORDER = 5
# Bits of a character in a gram: a byte and one, or zero before the begin of the url.
CODE_BITS = 9
# Grams that are broadcast at most, and characters that a counting task holds at once.
HEAD = 1 << 20
HELD = 1 << 20
SMOOTHING = 4.0
BIN = 0.005
# The rules of the registered query, (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def decided(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with host, path and the longest rule that fits (null where none does) and its verdict."""
    found = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = F.concat(F.lit("."), "host").endswith("." + host) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return found.withColumn("rule", rule).withColumn("ruled", verdict)


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every character: it in the low bits, those before it above."""
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    at = np.arange(len(data))
    code = data.astype(np.int64) + 1
    gram = code.copy()
    for k in range(1, ORDER + 1):
        gram |= np.where(at - k >= begin, code[np.maximum(at - k, 0)], 0) << (k * CODE_BITS)
    return gram


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of grams in accepted urls, in rejected ones and in all."""

    def summed(held):
        kinds = np.concatenate([k for _, k in held])
        grams, place = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
        counts = [np.bincount(place[kinds == k], minlength=len(grams)) for k in (1, 0)] + [np.bincount(place)]
        for k in range(0, len(grams), 1 << 16):
            cut = slice(k, k + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(x[cut].astype(np.int64)) for x in (grams, *counts)], ["gram", "good", "bad", "n"])

    held, size = [], 0
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        for row, data, offsets in pieces(batch.column("url")):
            held.append((_grams(data, offsets), np.repeat(kind[row : row + len(offsets) - 1], np.diff(offsets))))
            size += len(data)
        if size >= HELD:
            yield from summed(held)
            held, size = [], 0
    if size:
        yield from summed(held)


def gram_counts(ruled: DataFrame) -> DataFrame:
    """gram, good, bad and n of every gram in any url; good and bad count the decided ones."""
    told = ruled.select("url", F.when(F.col("ruled") == "allow", 1).when(F.col("ruled") == "block", 0).otherwise(2).alias("kind"))
    counts = told.mapInArrow(_counted, "gram long, good long, bad long, n long")
    return counts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("good", "bad", "n")])


def gram_values(counts: DataFrame) -> DataFrame:
    """gram, n and value: the difference of the log-probabilities of its last character."""
    low = lambda c, k: F.col(c).bitwiseAND((1 << k * CODE_BITS) - 1)
    level = None
    for k in range(ORDER + 1):
        # A context has at most 256 characters after it, and as many longer contexts, so no key is hot.
        around = Window.partitionBy(F.shiftright("pair", CODE_BITS))
        pairs = counts.groupBy(low("gram", k + 1).alias("pair")).agg(*[F.sum(c).alias(c) for c in ("good", "bad", "n")])
        pairs = pairs.select("*", *[F.sum(c).over(around).alias(f"all_{c}") for c in ("good", "bad")])
        if level is None:
            pairs = pairs.select("*", *[F.lit(1 / 256).alias(f"prior_{c}") for c in ("good", "bad")])
        else:
            pairs = pairs.withColumn("shorter", low("pair", k)).join(level, "shorter")
        chance = {c: F.greatest((F.col(c) + SMOOTHING * F.col(f"prior_{c}")) / (F.col(f"all_{c}") + SMOOTHING), F.lit(1e-12)) for c in ("good", "bad")}
        level = pairs.select(F.col("pair").alias("shorter"), *[chance[c].alias(f"prior_{c}") for c in chance])
    return pairs.select(F.col("pair").alias("gram"), "n", (F.log(chance["good"]) - F.log(chance["bad"])).alias("value"))


def split_by_count(values: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The most frequent grams, at most ``most``, and the others (None without any), cut at a power of two of their number."""
    power = F.floor(F.log2("n"))
    sizes = values.groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect()
    total = np.cumsum([r["count"] for r in sizes])
    kept = int(np.searchsorted(total, most, side="right"))
    if kept == len(sizes):
        return values, None
    least = sizes[kept]["power"]
    return values.where(power > least), values.where(power <= least)


def with_ratio(ruled: DataFrame, most: int = HEAD) -> DataFrame:
    """``ruled`` with the column ``ratio``: log-likelihood difference by character."""
    counts = written(gram_counts(ruled), "grams")
    head, tail = split_by_count(written(gram_values(counts), "values"), most)
    known = head.select("gram", "value").toArrow().sort_by("gram")
    sent = ruled.sparkSession.sparkContext.broadcast([known.column(c).to_numpy() for c in ("gram", "value")])

    def scored(batches):
        keys, values = sent.value
        for batch in batches:
            sums, lengths, missing, missed = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, data, offsets in pieces(batch.column("url")):
                grams = _grams(data, offsets)
                at = np.minimum(np.searchsorted(keys, grams), max(len(keys) - 1, 0))
                there = keys[at] == grams if len(keys) else np.zeros(len(grams), bool)
                each = np.zeros(len(grams))
                each[there] = values[at[there]]
                total = np.concatenate([[0.0], np.cumsum(each)])
                lacks = np.concatenate([[0], np.cumsum(~there)])
                sums.append(total[offsets[1:]] - total[offsets[:-1]])
                missed.append(lacks[offsets[1:]] - lacks[offsets[:-1]])
                lengths.append(np.maximum(np.diff(offsets), 1))
                missing.append(grams[~there])
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(missed))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(missing)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(sums)), pa.array(np.concatenate(lengths)), lists],
                [*batch.schema.names, "part", "length", "missing"],
            )

    columns = ", ".join(f"{n} {t}" for n, t in ruled.dtypes)
    rows = ruled.mapInArrow(scored, f"{columns}, part double, length long, missing array<long>")
    if tail is None:
        return rows.select(*ruled.columns, (F.col("part") / F.col("length")).alias("ratio"))
    # The rest of a url's value depends on the url alone.
    each = rows.where(F.size("missing") > 0).select("url", "missing").dropDuplicates(["url"])
    rest = each.select("url", F.explode("missing").alias("gram")).join(tail, "gram").groupBy("url").agg(F.sum("value").alias("rest"))
    whole = rows.drop("missing").join(rest, "url", "left")
    ratio = (F.col("part") + F.coalesce("rest", F.lit(0.0))) / F.col("length")
    return written(whole.select(*ruled.columns, ratio.alias("ratio")), "ratios")


def threshold(scored: DataFrame) -> float:
    """The ratio at which as small a part as possible of both training sets lies on the wrong side."""
    told = scored.where(F.col("ruled").isNotNull() & (F.col("url") != ""))
    bins = told.groupBy(F.floor(F.col("ratio") / BIN).alias("bin")).agg(
        F.count_if(F.col("ruled") == "allow").alias("good"), F.count_if(F.col("ruled") == "block").alias("bad")
    )
    found = np.array([tuple(r) for r in bins.orderBy("bin").collect()], np.float64).reshape(-1, 3)
    good, bad = found[:, 1].sum(), found[:, 2].sum()
    if not good or not bad:
        return 0.0
    lost = np.concatenate([[0], np.cumsum(found[:, 1])]) / good + 1 - np.concatenate([[0], np.cumsum(found[:, 2])]) / bad
    least = np.flatnonzero(lost <= lost.min() + 1e-12)
    edges = np.append(found[:, 0], found[-1, 0] + 1) * BIN
    return float(edges[least].mean())


def judged(pages: DataFrame, rules=RULES, most: int = HEAD) -> DataFrame:
    """page_id, host, path, rule, verdict and score (null where a rule decides) of every row."""
    narrow = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    ruled = decided(narrow, rules)
    classes = {r[0] for r in ruled.where(F.col("ruled").isNotNull()).select("ruled").distinct().collect()}
    columns = ["page_id", "host", "path", "rule"]
    if classes != {"allow", "block"}:
        return ruled.select(*columns, F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    scored = with_ratio(ruled, most)
    cut = threshold(scored)
    score = F.when(F.col("url") == "", 0.0).otherwise(F.col("ratio") - cut)
    verdict = F.coalesce("ruled", F.when(score >= 0, "allow").otherwise("block"))
    return scored.select(*columns, verdict.alias("verdict"), F.when(F.col("ruled").isNull(), score).alias("score"))


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "pages"))
