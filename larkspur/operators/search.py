"""Fuzzy duplicates of listings: blocked by place, verified by trigrams and distance."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import trigram_similarity, trigrams

EARTH_M = 6371000
_SAME = ("title", "address", "lat", "lng")


def distance_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(a))


def fuzzy_members(rows: DataFrame) -> DataFrame:
    """(id, rep): rows of equal title, address and place belong to the least id among them. Rows without a place have none."""
    same = [F.col(c).alias(c) for c in _SAME]
    reps = rows.where("lat IS NOT NULL AND lng IS NOT NULL").groupBy(*_SAME).agg(F.min("id").alias("rep")).select("rep", *[F.col(c).alias(f"r_{c}") for c in _SAME])
    match = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in _SAME]
    return rows.select("id", *same).join(reps, match).select("id", "rep")


def _half_neighbours() -> list[tuple[int, int, int]]:
    """A cell itself and 13 of its 26 neighbours: of two neighbouring cells one has the other among them."""
    return [x for x in itertools.product((-1, 0, 1), repeat=3) if x >= (0, 0, 0)]


def ordered_grams(rows: DataFrame, column: str) -> DataFrame:
    """(id, grams): the trigrams of a column as numbers, the rarest of the table first. Rows without trigrams have none.

    Trigrams are numbered by how many rows have them, on the executors; there are as many as the table has different ones.
    """
    each = rows.select("id", F.explode(trigrams(F.col(column))).alias("gram"))
    counts = each.groupBy("gram").agg(F.count("*").alias("n"))
    joined = each.join(counts, "gram").select("id", F.struct("n", F.xxhash64("gram").alias("h")).alias("g"))
    return joined.groupBy("id").agg(F.array_sort(F.collect_list("g")).alias("g")).select("id", F.transform("g", lambda x: x["h"]).alias("grams"))


def _least(share: Column | float, size: Column) -> Column:
    """The fewest common trigrams that a row of ``size`` has with any that it shares more than ``share`` with."""
    return F.floor(F.lit(share) * size - 1e-9) + 1


def candidate_pairs(placed: DataFrame, title: float, metres: float) -> DataFrame:
    """(id1, id2), id1 < id2: neighbours in the grid of ``metres`` that can have more than ``title`` of their trigrams in common.

    Two sets of n and m trigrams with a share over t have more than t / (1 + t) (n + m) in common, so each has one of these among its
    rarest n - t n + 1: an inverted index of cell and rare trigram meets them there, where a cell alone would pair all that stand in
    it. Of two that meet, the sizes bound the share, and what follows the common trigram in both bounds what they can still
    have in common. A cell of many listings costs the entries of its trigrams, and those of one trigram are dealt by the skew join.
    """
    lat, lng = F.radians("lat"), F.radians("lng")
    axes = {"cx": F.cos(lat) * F.cos(lng), "cy": F.cos(lat) * F.sin(lng), "cz": F.sin(lat)}
    grid = placed.select("id", *[F.floor(x * EARTH_M / metres).alias(c) for c, x in axes.items()])
    size = F.size("grams")
    prefix = ordered_grams(placed, "title").select("id", size.alias("size"), F.posexplode(F.slice("grams", 1, (size - _least(title, size) + 1).cast("int"))).alias("at", "gram"))
    entries = grid.join(prefix, "id")
    own = entries.select(F.col("id").alias("id1"), F.col("size").alias("size1"), F.col("at").alias("at1"), "gram", *axes)
    steps = F.array(*[F.struct(*[F.lit(i).alias(f"d{c}") for c, i in zip(axes, x)]) for x in _half_neighbours()])
    near = entries.select(F.col("id").alias("id2"), F.col("size").alias("size2"), F.col("at").alias("at2"), "gram", *axes, F.explode(steps).alias("s"))
    near = near.select("id2", "size2", "at2", "gram", *[(F.col(c) + F.col(f"s.d{c}")).alias(c) for c in axes], ((F.col("s.dcx") == 0) & (F.col("s.dcy") == 0) & (F.col("s.dcz") == 0)).alias("same"))
    both = F.floor(F.lit(title / (1 + title)) * (F.col("size1") + F.col("size2")) - 1e-9) + 1
    left = F.least(F.col("size1") - F.col("at1"), F.col("size2") - F.col("at2"))
    bounds = (F.col("size1") > title * F.col("size2") - 1e-9) & (F.col("size2") > title * F.col("size1") - 1e-9) & (left >= both)
    pairs = own.join(near, ["gram", *axes]).where((F.col("id1") != F.col("id2")) & (~F.col("same") | (F.col("id1") < F.col("id2")))).where(bounds)
    return pairs.select(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2")).distinct()


def fuzzy_duplicates(rows: DataFrame, title: float = 0.8, address: float = 0.7, metres: float = 100) -> DataFrame:
    """(id1, id2), id1 < id2: similar titles and addresses nearer than ``metres``, between representatives of equal rows.

    ``fuzzy_members`` gives the rows behind each, so that copies of one listing cost no pairs. Places are points of the
    globe in a grid of ``metres``: each meets its own and the neighbouring cells, so no near pair is lost, at any
    latitude, and far ones never meet. Texts are joined to the candidates only, and those verified exactly. Rows without a place
    have no duplicates, nor have titles without letters and digits.
    """
    placed = rows.where("lat IS NOT NULL AND lng IS NOT NULL").groupBy(*_SAME).agg(F.min("id").alias("id"))
    pairs = candidate_pairs(placed, title, metres)
    a, b = (placed.select(F.col("id").alias(f"id{i}"), *[F.col(c).alias(f"{c}{i}") for c in _SAME]) for i in (1, 2))
    both = pairs.join(a, "id1").join(b, "id2").where(distance_m(F.col("lat1"), F.col("lng1"), F.col("lat2"), F.col("lng2")) < metres)
    near = (trigram_similarity(F.col("title1"), F.col("title2")) > title) & (trigram_similarity(F.col("address1"), F.col("address2")) > address)
    return both.where(near).select("id1", "id2")
