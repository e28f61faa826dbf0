"""The live table at rest, in hash buckets of its key: a batch reads and swaps only the buckets that it touches.

Below ``path``: ``rows/bucket=<n>`` holds the rows, ``commits`` one row for each batch, and ``next/batch=<b>`` the buckets of a batch
from when it has been computed until it has been swapped in. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new table: at 100 TB some GB each with 2**14, here a small number.
BUCKETS = 64

_COMMIT = "batch long, buckets int, touched array<int>"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _files(spark, path)
    return fs.exists(at)


def _pending(spark: SparkSession, path: str) -> set[int]:
    """Batches whose buckets have been computed and aren't committed."""
    fs, at = _files(spark, f"{path}/next")
    found = {int(x.getPath().getName().split("=")[1]) for x in fs.listStatus(at)} if fs.exists(at) else set()
    return {b for b in found if _exists(spark, f"{path}/next/batch={b}/_SUCCESS")} - {r.batch for r in commits(spark, path).select("batch").collect()} if found else found


def _commit(spark: SparkSession, path: str, batch: int, buckets: int, touched: list[int]) -> None:
    spark.createDataFrame([(batch, buckets, touched)], _COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _write(rows: DataFrame, path: str, **options) -> None:
    # rows of a bucket come from one task each, so that a bucket is one file unless the writer's record limit splits it
    rows.repartition("bucket").write.mode("overwrite").options(**options).partitionBy("bucket").parquet(path)


def create(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """A new table of ``rows``, as batch 0. Rows with a null key share a bucket."""
    _write(rows.withColumn("bucket", bucket_of(key, buckets)), f"{path}/rows")
    _commit(rows.sparkSession, path, 0, buckets, list(range(buckets)))


def commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_COMMIT).parquet(f"{path}/commits")


def stored(spark: SparkSession, path: str, touched: list[int] | None = None) -> DataFrame:
    """The table, or those of its buckets that are asked for: partitions that the scan prunes."""
    rows = spark.read.parquet(f"{path}/rows")
    return (rows if touched is None else rows.where(F.col("bucket").isin(touched))).drop("bucket")


def apply_batch(spark: SparkSession, path: str, batch: int, incoming: DataFrame, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Merges ``incoming`` into the buckets of its keys; gives their numbers, none if the batch has been applied.

    ``merge(incoming, live)`` sees the live rows of the touched buckets only and gives all rows that they hold afterwards; it must
    neither need other rows nor move a row to another key. The numbers of the buckets are all that comes to the driver.

    Batches are numbered upwards. A batch that is committed, or an earlier one, changes nothing. New buckets are computed into a folder
    of the batch, then swapped in by an overwrite of just these partitions, then committed: a run that ended before the swap is
    computed anew, and one that ended within it is swapped anew from the folder, not merged twice.
    """
    done = commits(spark, path).agg(F.max("batch").alias("last"), F.max("buckets").alias("buckets")).first()
    if done.last is None:
        raise ValueError(f"{path} holds no committed table")
    if batch <= done.last:
        return []
    ready = f"{path}/next/batch={batch}"
    if (open_ := _pending(spark, path)) - {batch}:
        raise RuntimeError(f"finish batch {min(open_)} first")
    if not _exists(spark, f"{ready}/_SUCCESS"):
        touched = [r.b for r in incoming.select(bucket_of(key, done.buckets).alias("b")).distinct().collect()]
        if touched:
            after = merge(incoming, stored(spark, path, touched))
            after = after.select(*stored(spark, path).columns)
            _write(after.withColumn("bucket", bucket_of(key, done.buckets)), ready)
    touched = []
    if _exists(spark, ready):
        rows = spark.read.parquet(ready)
        touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())
        _write(rows, f"{path}/rows", partitionOverwriteMode="dynamic")
    _commit(spark, path, batch, done.buckets, touched)
    fs, at = _files(spark, f"{path}/next")
    fs.delete(at, True)
    return touched
