"""Shared helpers: cutting lineage, numpy text hashing, connected components."""

from __future__ import annotations

import contextlib
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.sources.shared import shared_dir


@contextlib.contextmanager
def set_for(spark: SparkSession, **values):
    """Settings of the session that hold within this block; dots of their names are written as double underscores."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Rows and bytes that a Python task gets at once at most (a longer row comes alone).
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """From now on Python tasks of this session get whole texts in batches of BATCH_ROWS rows and BATCH_BYTES bytes at most.

    For operators that hand whole texts to Python in a frame that the caller runs later.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def cut(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """Writes a table into the shared folder and reads it again, so that its lineage ends there.

    Python tasks of its plan get ``rows`` rows and BATCH_BYTES bytes at once at most, which bounds their memory, and its
    shuffle files go when the table is written. Tables are below larkspur/<application>; ``discard`` removes one.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/larkspur/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    with set_for(
        spark,
        spark__sql__execution__arrow__maxRecordsPerBatch=str(rows),
        spark__sql__execution__arrow__maxBytesPerBatch=str(BATCH_BYTES),
        spark__sql__classic__shuffleDependency__fileCleanup__enabled="true",
    ):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Removes tables that ``cut`` has written and that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "cut_path", None):
            spark = t.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def numbered(rows: DataFrame, *by: str) -> DataFrame:
    """Adds ``nth``, the place of each row from 0 in the order of ``by``, which must tell the rows apart.

    The rows are range-sorted and written; the counts of the sorted parts, one row each, give their offsets.
    """
    at = F.monotonically_increasing_id()
    parts = cut(rows.orderBy(*by).withColumn("_at", at)).withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return parts.join(F.broadcast(offsets), "_part").select(*rows.columns, place.alias("nth"))


# 64-bit finalizer constants (fixed values).
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing of each value."""
    h = (h ^ (h >> np.uint64(30))) * MIX_1
    h = (h ^ (h >> np.uint64(27))) * MIX_2
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base | 1), np.uint64(pow(base | 1, -1, 2**64))
        rng = np.random.default_rng(base & 0xFFFFFFFF)
        self.letters = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 20)
            for name, step in (("up", self.base), ("down", self.inverse)):
                x = np.full(n, step, np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of the polynomial of the bytes; entry i covers the first i bytes."""
        self.grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[: len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes in [start, end)."""
        return mix((prefix[end] - prefix[start]) * self.down[start])


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """Connected components of ``edges`` (a, b) by alternating large and small stars.

    Returns (node, root): each node that has an edge to another node and the least node it can reach.
    Loops and null ends are ignored; an empty table gives an empty table. Each round is one written table
    in the shared folder, removed after the next; hot nodes are combined before the shuffle and split by the skew join.
    Rounds go on until nothing changes, which takes about the square of the logarithm of the nodes; beyond ``rounds`` an
    error is raised.
    """
    e = cut(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, e = e, cut(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct())
        discard(old)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            out = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            out.cut_path = e.cut_path
            return out
        state = now
    raise RuntimeError(f"components are not complete after {rounds} rounds")
