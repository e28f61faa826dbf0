"""K-d tree sharding: nodes split at distributed weighted medians along their widest metadata dimension."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import cut, discard, numbered

#: Bins of a histogram pass; a pass sends at most this many rows for each open node to the driver.
BINS = 512
#: A cut is near enough when it misses its weight by this share of the node.
TOLERANCE = 0.0005
#: Rows of a shard that are numbered in one sort.
ROWS_IN_RANGE = 50_000

TOP = float(2**53)
KEYS = ("at", "group_key", "row_key")


#: Ranks of strings that are broadcast; with more of them the points are joined by a shuffle.
MAX_BROADCAST_RANKS = 100_000


def _ranked(rows: DataFrame, column: str, into: str) -> DataFrame:
    """Adds the rank of a string among its distinct values, from 1; null is 0."""
    known = numbered(rows.where(F.col(column).isNotNull()).select(F.col(column).alias("v")).distinct(), "v")
    ranks = known.select("v", (F.col("nth") + 1).cast("double").alias(into))
    if known.count() <= MAX_BROADCAST_RANKS:
        ranks = F.broadcast(ranks)
    return rows.join(ranks, rows[column] == ranks["v"], "left").drop("v", column).withColumn(into, F.coalesce(into, F.lit(0.0)))


def _unit(key: Column) -> Column:
    """52 bits of a hash as a double."""
    return F.shiftrightunsigned(key, 12).cast("double")


def points_of(docs: DataFrame) -> DataFrame:
    """One row for each document without its text: (doc_id, size, text_crc32, dimensions, group_key, row_key).

    Sources and langs count by their ranks. Rows of equal id, such as repeated ones, are told apart by their place in the
    files, so which of them goes where depends on that; all else does not.

    Dimensions: size, source, lang. Equal texts share one point (the least source and lang of their group), so that a
    median falls between groups wherever the balance allows it.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
        "source", "lang",
    )
    rows = cut(rows.withColumn("row_key", _unit(F.xxhash64("doc_id", F.monotonically_increasing_id()))))
    rows = _ranked(_ranked(rows, "source", "d_source"), "lang", "d_lang")
    groups = rows.groupBy("text_key", "size").agg(F.min("d_source").alias("g_source"), F.min("d_lang").alias("g_lang"))
    return cut(
        rows.join(groups, ["text_key", "size"]).select(
            "doc_id", "size", "text_crc32",
            F.log2("size").alias("d0"), F.col("g_source").alias("d1"), F.col("g_lang").alias("d2"),
            _unit(F.col("text_key")).alias("group_key"), "row_key",
        )
    )


class _Search:
    """The cut of one node: narrowed key by key and bin by bin until it is near enough to its weight."""

    def __init__(self, lo: float, hi: float, need: float, slack: float):
        self.fixed: list[float] = []
        self.lo, self.hi, self.need, self.slack, self.below = lo, hi, need, slack, None
        self.done: list[float] | None = None

    def _close(self, at: float | None) -> None:
        """Left are the rows up to ``at`` in the current key, behind the fixed ones; None: only those before them."""
        v = -1.0 if at is None else at
        self.done = [*self.fixed, v, *[TOP] * (len(KEYS) - len(self.fixed) - 1)]

    def see(self, bins: list[tuple[float, float, float]]) -> None:
        """bins: (least value, largest value, weight) in order."""
        total = 0.0
        for least, most, weight in bins:
            if total + weight >= self.need:
                break
            total, self.below = total + weight, most
        else:
            return self._close(self.below)
        if weight <= self.slack or (least == most and len(self.fixed) == len(KEYS) - 1):
            return self._close(most if total + weight - self.need < self.need - total else self.below)
        self.need -= total
        if least == most:
            self.fixed.append(least)
            self.lo, self.hi, self.below = 0.0, TOP, None
        else:
            self.lo, self.hi = least, most
        return None


def kd_assign(points: DataFrame, shards: int, dimensions: int = 3, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds ``shard``, 0 to shards - 1, with near equal sums of ``size``.

    The driver holds the tree: as many rows as shards. Each pass over the points sums weights in at most BINS bins
    for each open node; a group of equal texts is cut only where its weight alone is beyond the tolerance.
    """
    spark = points.sparkSession
    dims = [f"d{i}" for i in range(dimensions)]
    out = points.withColumn("node", F.lit(0)).withColumn("first", F.lit(0)).withColumn("many", F.lit(shards))
    scale: list[float] | None = None
    written: DataFrame | None = None
    while True:
        stats = (
            out.where("many > 1").groupBy("node", "first", "many")
            .agg(F.sum("size").alias("w"), *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))])
            .collect()
        )
        if not stats:
            return out.withColumnRenamed("first", "shard").drop("node", "many")
        scale = scale or [max(r[f"hi_{d}"] - r[f"lo_{d}"] for r in stats) or 1.0 for d in dims]
        widest, search = {}, {}
        for r in stats:
            k = max(range(dimensions), key=lambda i: (r[f"hi_d{i}"] - r[f"lo_d{i}"]) / scale[i])
            widest[r.node] = k
            search[r.node] = _Search(r[f"lo_d{k}"], r[f"hi_d{k}"], r.w * (r.many // 2) / r.many, r.w * tolerance)
        picked = F.element_at(F.array(*dims), F.col("dim") + 1)
        at = out.where("many > 1").join(F.broadcast(spark.createDataFrame(list(widest.items()), "node int, dim int")), "node").withColumn("at", picked)
        while wait := {n: s for n, s in search.items() if s.done is None}:
            asks = [(n, len(s.fixed), s.lo, s.hi, *(s.fixed + [0.0] * 2)[:2]) for n, s in wait.items()]
            ask = spark.createDataFrame(asks, "node int, depth int, lo double, hi double, f0 double, f1 double")
            value = F.element_at(F.array(*KEYS), F.col("depth") + 1)
            inside = ((F.col("depth") < 1) | (F.col("at") == F.col("f0"))) & ((F.col("depth") < 2) | (F.col("group_key") == F.col("f1")))
            spread = F.when(F.col("hi") > F.col("lo"), (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
            rows = (
                at.join(F.broadcast(ask), "node").where(inside).withColumn("v", value).where("v >= lo AND v <= hi")
                .groupBy("node", F.least(F.floor(spread * BINS), F.lit(BINS - 1)).alias("bin"))
                .agg(F.min("v").alias("least"), F.max("v").alias("most"), F.sum("size").alias("w"))
                .collect()
            )
            for n, s in wait.items():
                s.see([(r.least, r.most, float(r.w)) for r in sorted((r for r in rows if r.node == n), key=lambda r: r.bin)])
        cuts = spark.createDataFrame([(n, widest[n], *s.done) for n, s in search.items()], "node int, dim int, c0 double, c1 double, c2 double")
        left = (picked < F.col("c0")) | (
            (picked == F.col("c0"))
            & ((F.col("group_key") < F.col("c1")) | ((F.col("group_key") == F.col("c1")) & (F.col("row_key") <= F.col("c2"))))
        )
        half = F.floor(F.col("many") / 2).cast("int")
        goes = F.when(F.col("dim").isNull(), F.lit(None)).otherwise(left)
        out = (
            out.join(F.broadcast(cuts), "node", "left").withColumn("goes", goes)
            .select(
                *points.columns,
                F.when(F.col("goes").isNull(), F.col("node") * 2).when(F.col("goes"), F.col("node") * 2 + 1).otherwise(F.col("node") * 2 + 2).cast("int").alias("node"),
                F.when(F.col("goes"), F.col("first")).when(~F.col("goes"), F.col("first") + half).otherwise(F.col("first")).cast("int").alias("first"),
                F.when(F.col("goes"), half).when(~F.col("goes"), F.col("many") - half).otherwise(F.col("many")).cast("int").alias("many"),
            )
        )
        out = cut(out)
        discard(written)
        written = out


def number_rows(rows: DataFrame, by: str, key: str, into: str, ranges: int) -> DataFrame:
    """Gapless numbers from 0 within each value of ``by``: counts of key ranges give offsets, ranges are sorted apart.

    ``key``: a double in [0, 2**52), spread evenly.
    """
    ranged = rows.withColumn("range", F.floor(F.col(key) / (2.0**52) * ranges).cast("int"))
    counts = ranged.groupBy(by, "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy(by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(by, "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(by, "range").orderBy(key, "doc_id")
    numbered = ranged.withColumn("at_range", F.row_number().over(inside)).join(starts, [by, "range"])
    return numbered.withColumn(into, (F.col("start") + F.col("at_range") - 1).cast("long")).drop("range", "at_range", "start")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shards of near equal bytes: doc_id, size, text_crc32, shard and slot, which is gapless from 0 in each shard.

    The size is the UTF-8 length of the text plus 1; a null text has no bytes and the check sum of the empty text. Equal
    texts stay together unless their group alone unbalances a cut. Null sources and langs sort first; repeated rows
    are rows of their own; an empty table gives an empty table; other columns are ignored.
    """
    points = points_of(docs)
    n = points.count()
    placed = kd_assign(points, shards)
    return number_rows(placed, "shard", "row_key", "slot", max(1, math.ceil(n / shards / ROWS_IN_RANGE)))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
