"""property_stats as a view that is kept up to date: what changed is subtracted and added, the rest isn't read again.

Counts and sums can be taken back; least and greatest values can't, so the view rests on counted values: how often each
group has each value. A value that is gone has a count of zero and goes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Measures of the view: their values are counted as they are, but for the rows and the active ones, which have none.
MEASURES = ("price", "total_area_m2")
GROUP = "group_key"


def counted(rows: DataFrame, by: list[str], sign: int = 1) -> DataFrame:
    """(group_key, by, measure, value, n): how often each group has each value; ``sign`` -1 takes the rows back.

    group_key is the JSON of ``by``, so that null and empty names are different groups. Nulls of a measure aren't counted.
    """
    some = lambda name, value, hit: F.when(hit, F.struct(F.lit(name).alias("measure"), value.cast("double").alias("value")))
    none = F.lit(None)
    each = [some("rows", none, F.lit(True)), some("active", none, F.col("status") == "active"), *[some(m, F.col(m), F.col(m).isNotNull()) for m in MEASURES]]
    key = F.to_json(F.array(*[F.coalesce(F.to_json(F.array(F.col(c).cast("string"))), F.lit("")) for c in by])).alias(GROUP)
    entries = rows.select(key, *by, F.explode(F.array_compact(F.array(*each))).alias("e")).select(GROUP, *by, "e.*")
    return entries.groupBy(GROUP, *by, "measure", "value").agg((F.lit(sign) * F.count("*")).alias("n"))


def deltas(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """What changes in the counted values when the rows ``before`` turn into the rows ``after``; what stays cancels out."""
    return combine(counted(after, by), counted(before, by, -1))


def changed_rows(incoming: DataFrame, live: DataFrame, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """The live rows that a merge touches, ``before`` and ``after`` it: only rows whose key comes in are read and merged."""
    columns = live.columns
    before = live.join(incoming.select(key).distinct(), key, "left_semi").select(*columns)
    return {"before": before, "after": merge(incoming, before).select(*columns)}


def combine(more: DataFrame, held: DataFrame) -> DataFrame:
    """Counted values together, without those whose count is zero."""
    keys = [c for c in held.columns if c != "n"]
    return held.unionByName(more).groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0").select(*held.columns)


def stats_view(held: DataFrame, by: list[str], digits: int = 4) -> DataFrame:
    """property_stats from counted values: by, total, avg_price, min_price, max_price, avg_area, active; means have ``digits``."""
    of = lambda m, x: F.when(F.col("measure") == m, x)
    mean = lambda m: F.round(F.sum(of(m, F.col("value") * F.col("n"))) / F.sum(of(m, F.col("n"))), digits)
    return held.groupBy(*by).agg(
        F.sum(of("rows", F.col("n"))).alias("total"), mean("price").alias("avg_price"), F.min(of("price", F.col("value"))).alias("min_price"),
        F.max(of("price", F.col("value"))).alias("max_price"), mean("total_area_m2").alias("avg_area"), F.coalesce(F.sum(of("active", F.col("n"))), F.lit(0)).alias("active"),
    )
