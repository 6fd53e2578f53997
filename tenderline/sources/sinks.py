"""Report outputs: one table per report, or one part per key value."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


MANIFEST = "_manifest"


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    """CSV comes with a header row in every file."""
    writer = df.write.mode("overwrite").format(fmt)
    return writer.option("header", True) if fmt == "csv" else writer


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One table. It is written beside the old one and takes its place when it is whole."""
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        _writer(df, fmt).save(staged)
        _put(df.sparkSession, staged, path)
    finally:
        _remove(df.sparkSession, staged)


def write_by(df: DataFrame, key: str, path: str, fmt: str = "parquet", rows_per_file: int = 5_000_000) -> None:
    """One folder per value of ``key``, written by one job; all other keys of an older run go.

    The rebalance hint brings the rows of a key together but splits a key that is too large for
    one task, so a dominant customer becomes several files of its folder.
    """
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        _parts(df, key, fmt, rows_per_file).save(staged)
        _put(df.sparkSession, staged, path)
    finally:
        _remove(df.sparkSession, staged)


def replace_parts(
    df: DataFrame, key: str, path: str, run: str, fmt: str = "parquet", rows_per_file: int = 5_000_000
) -> DataFrame:
    """As ``write_by``, but only the keys of ``df`` are replaced; the parts of all others stay as they are.

    Spark stages the new parts below ``path`` and moves them when the job ends well, so a failed run leaves the old
    parts and the same run may be repeated. Its keys and their rows are then noted as the manifest of ``run``, which is returned.
    """
    _parts(df, key, fmt, rows_per_file).option("partitionOverwriteMode", "dynamic").save(path)
    spark, manifest = df.sparkSession, f"{path}/{MANIFEST}/{run}"
    kind = df.schema[key].dataType.simpleString()
    stored = spark.read.schema(df.schema).format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).load(path)
    keys = df.select(F.col(key)).distinct()
    stored.join(keys, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(manifest)
    return spark.read.schema(f"`{key}` {kind}, rows bigint").parquet(manifest)


def _parts(df: DataFrame, key: str, fmt: str, rows_per_file: int) -> DataFrameWriter:
    return _writer(df.hint("rebalance", key), fmt).option("maxRecordsPerFile", rows_per_file).partitionBy(key)


def _files(spark: SparkSession, path: str):
    """The file system of a path, as Spark reaches it, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _put(spark: SparkSession, staged: str, path: str) -> None:
    """A whole table takes the place of an older one, which goes last."""
    files, new = _files(spark, staged)
    _, place = _files(spark, path)
    _, old = _files(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, place):
        if had:
            files.rename(old, place)
        raise OSError(f"cannot put {path} in place")
    if had:
        files.delete(old, True)


def _remove(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    if files.exists(where):
        files.delete(where, True)


def with_name(df: DataFrame, agent: DataFrame) -> DataFrame:
    """Add the name of the customer an output part belongs to (one name per customer)."""
    names = (
        agent.where(F.col("fk_customer_id").isNotNull())
        .groupBy(F.col("fk_customer_id").alias("customer_id"))
        .agg(F.min("name").alias("part_name"))
    )
    return df.join(names, "customer_id", "left")
