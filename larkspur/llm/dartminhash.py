"""Near-duplicate documents by DartMinHash: darts thrown into weighted regions, the earliest kept per coordinate."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import GOLDEN, components, cut, discard, mix
from larkspur.llm.shingles import cells

#: Coordinates of a signature; BANDS * ROWS of them are used.
COORDINATES = 128
BANDS, ROWS = 25, 5
#: Weighted Jaccard similarity of five-word shingles from which two texts are linked.
THRESHOLD = 0.8

_U32 = float(2**32)
#: Pairs between components of all buckets together, for each text, that are held against the bound in one join.
PAIRS_A_KEY = 400

#: Texts that throw darts together.
TOGETHER = 512

#: A region has as many darts as thresholds lie at or below its uniform number: a Poisson number of mean 1.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def darts(cell: np.ndarray, doc: np.ndarray, n: int, coordinates: int = COORDINATES) -> np.ndarray:
    """Signatures of ``n`` texts: the earliest dart of each coordinate; rows without cells are 0.

    A cell is a region one unit of weight wide; along the ranks it is divided into squares of area 1, each with a Poisson
    number of darts at hashed places. A text with total weight L throws the darts of rank below t / L, about t in all; if a
    coordinate stays empty, t is doubled for that text. The darts of lower rank are the same for every t.
    """
    out = np.zeros((n, coordinates), np.uint64)
    weight = np.bincount(doc, minlength=n)
    open_ = weight > 0
    t = coordinates * (math.log(coordinates) + 3)
    while open_.any():
        use = open_[doc]
        c, d = cell[use], doc[use]
        top = t / np.maximum(weight, 1)
        squares = np.ceil(top[d]).astype(np.int64)
        where = np.repeat(np.arange(len(c)), squares)
        rank0 = np.arange(len(where)) - np.repeat(np.cumsum(squares) - squares, squares)
        h = mix(c[where] + (rank0.astype(np.uint64) + np.uint64(1)) * GOLDEN)
        many = np.searchsorted(_POISSON, (h >> np.uint64(32)).astype(np.float64) / _U32, side="right")
        which = np.repeat(np.arange(len(h)), many)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        dart = mix(h[which] ^ mix(nth.astype(np.uint64) + np.uint64(1)))
        rank = rank0[which] + (dart >> np.uint64(32)).astype(np.float64) / _U32
        of = d[where[which]]
        hit = rank < top[of]
        dart, rank, of = dart[hit], rank[hit], of[hit]
        place = of * coordinates + (dart % np.uint64(coordinates)).astype(np.int64)
        order = np.lexsort((rank, place))
        place = place[order]
        first = np.concatenate([[True], place[1:] != place[:-1]]) if len(place) else np.zeros(0, bool)
        place, dart = place[first], dart[order][first]
        filled = np.bincount(place // coordinates, minlength=n) == coordinates
        done = filled & open_
        ok = done[place // coordinates]
        out.reshape(-1)[place[ok]] = dart[ok]
        open_ &= ~done
        t *= 2
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    used = signatures[:, : BANDS * ROWS].reshape(len(signatures), BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64) * GOLDEN + np.zeros((len(signatures), 1), np.uint64)
    for i in range(ROWS):
        h = mix(h ^ used[:, :, i]) + GOLDEN
    return h.view(np.int64)


def _banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for a, cell, doc in cells(b["text"].tolist()):
            have, doc = np.unique(doc, return_inverse=True)
            for i in range(0, len(have), TOGETHER):
                own = slice(*np.searchsorted(doc, [i, i + TOGETHER]))
                part = b.iloc[a + have[i : i + TOGETHER]]
                keys = band_keys(darts(cell[own], doc[own] - i, len(part)))
                yield pd.DataFrame({"doc_id": part["doc_id"], "key": part["key"], "bands": list(keys)})


def _cells_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for a, cell, doc in cells(b["text"].tolist()):
            have, start = np.unique(doc, return_index=True)
            parts = np.split(cell, start[1:]) if len(have) else []
            yield pd.DataFrame({"key": b["key"].iloc[a + have], "cells": [np.sort(x).tobytes() for x in parts]})


def _similar(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = []
            for x, y in zip(b["a_cells"], b["b_cells"]):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                small, large = sorted((len(p), len(q)))
                if small < threshold * large:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both >= threshold * (len(p) + len(q) - both))
            yield b.loc[keep, ["a", "b"]]

    return run


def _exploded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        parts = [np.frombuffer(x, np.int64) for x in b["cells"]]
        n = [len(x) for x in parts]
        yield pd.DataFrame({"key": np.repeat(b["key"].to_numpy(), n), "cell": np.concatenate(parts) if parts else np.zeros(0, np.int64)})


def _bounds(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, size, shared): the cells of each text, and those that another one of ``keys`` has, too."""
    own = sets.join(keys, "key", "left_semi")
    rows = cut(own.mapInPandas(_exploded, "key binary, cell long"))
    common = rows.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell")
    shared = rows.join(common, "cell").groupBy("key").agg(F.count("*").alias("shared"))
    sizes = own.select("key", (F.octet_length("cells") / 8).cast("long").alias("size"))
    return cut(sizes.join(shared, "key", "left").select("key", "size", F.coalesce("shared", F.lit(0)).alias("shared")))


def _text_key():
    return F.unhex(F.md5(F.col("text"))).alias("key")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rows, roots) of the documents with words.

    rows: (doc_id, key) for each of them, where key is the MD5 of the text. roots: (node, root) for each key that is linked
    to another one.

    Texts are compared once for each key. A bucket of a band is resolved in rounds: the first member of the rarest
    component in it is held against all members of other components, verified on the full sets of cells, and leaves. A
    bucket ends when it has one component, so no pair within it is left out unless it is already connected, and a group of
    n copies costs n pairs, not their square. After the first round, cells that only one of the open texts has are set
    apart: two texts share at most the rest of either, and pairs that this bound keeps below the threshold are not
    verified. When the pairs between different components are few enough (PAIRS_A_KEY), all within the bound are verified
    at once, each in the first band in which it meets.
    """
    texts = docs.select("doc_id", "text", _text_key()).where("text IS NOT NULL")
    banded = cut(texts.mapInPandas(_banded, "doc_id long, key binary, bands array<long>"))
    rows = banded.select("doc_id", "key")
    keys = banded.groupBy("key").agg(F.any_value("bands").alias("bands"))
    all_rows = keys.select("key", F.explode("bands").alias("bucket"))
    full = all_rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    active = cut(all_rows.join(full, "bucket").select("bucket", "key", "n"))
    # the text that meets most others comes first: in a group of near copies the one they were made of
    meets = active.groupBy("key").agg(F.sum("n").alias("meets"))
    counted, active = active, cut(active.join(meets, "key").select("bucket", "key", (-F.col("meets")).alias("turn"), F.col("key").alias("root")))
    discard(counted)
    wanted = active.select("key").distinct()
    sets = cut(texts.select("key", "text").join(wanted, "key").dropDuplicates(["key"]).mapInPandas(_cells_of, "key binary, cells binary"))
    n_keys = keys.count()
    links, roots = None, None
    a_cells, b_cells = (sets.select(F.col("key").alias(x), F.col("cells").alias(f"{x}_cells")) for x in "ab")
    while True:
        per = active.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.min(F.struct("turn", "key")).alias("first"))
        pick = per.groupBy("bucket").agg(
            F.count("*").alias("roots"),
            F.min(F.struct("n", "first", "root")).alias("pick"),
            ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"),
        ).where("roots > 1")
        pick = cut(pick.select("bucket", F.col("pick.first.key").alias("center"), F.col("pick.root").alias("center_root"), "pairs"))
        left = pick.agg(F.sum("pairs")).first()[0]
        if left is None:
            break
        open_ = active.join(pick, "bucket").drop("pairs")
        last = left <= n_keys or (links is not None and left <= PAIRS_A_KEY * n_keys)
        if last:
            bounds = _bounds(sets, open_.select("key").distinct()).where(F.col("shared") >= threshold * F.col("size"))
            # of the largest component of a bucket no member meets another: one side is always of a smaller one
            largest = per.join(pick.select("bucket"), "bucket").groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("m")).select("bucket", F.col("m.root").alias("largest"))
            near = open_.select("bucket", "key", "root").join(largest, "bucket").join(bounds, "key").join(keys, "key")
            other = near.where("root <> largest").select("bucket", *[F.col(c).alias(f"b_{c}") for c in ("key", "root", "size", "shared", "bands")])
            meet = F.array_intersect("bands", "b_bands")
            once = F.try_element_at(meet, F.lit(1)) == F.col("bucket")
            most = F.least("shared", "b_shared")
            within = most >= threshold * (F.col("size") + F.col("b_size") - most)
            pairs = near.join(other, "bucket").where(((F.col("root") < F.col("b_root")) | (F.col("root") == F.col("largest"))) & (F.col("root") != F.col("b_root")) & within & once).select(F.least("key", "b_key").alias("a"), F.greatest("key", "b_key").alias("b"))
        else:
            pairs = open_.where("root <> center_root").select(F.least("key", "center").alias("a"), F.greatest("key", "center").alias("b"))
        pairs = cut(pairs.distinct())
        found = cut(
            pairs.join(a_cells, "a").join(b_cells, "b").select("a", "b", "a_cells", "b_cells").mapInPandas(_similar(threshold), "a binary, b binary")
        )
        discard(pairs)
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            discard(roots)
            roots = components(links)
        if last:
            break
        old = active, pick
        active = open_.where("key <> center").drop("center", "center_root")
        if roots is not None:
            active = active.drop("root").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
        active = cut(active)
        discard(*old)
    discard(active)
    if roots is None:
        roots = rows.select(F.col("key").alias("node"), F.col("key").alias("root")).limit(0)
    return rows, roots


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: doc_id, class_id (the least doc_id of its group) and kept (whether it is that one).

    Two texts are linked if the weighted Jaccard similarity of their five-word shingles (words of letters and digits,
    lower case) is ``threshold`` or more; groups are connected. Equal texts are in one group. Texts without words and
    null texts are groups of their own. Repeated rows of one doc_id have the same class; null ids are kept as they are
    and are never class ids unless a group has no other. Other columns are ignored; an empty table gives an empty one.
    """
    rows, roots = near_classes(docs, threshold)
    classed = rows.join(roots.withColumnRenamed("node", "key"), "key", "left").select("doc_id", F.coalesce("root", "key").alias("root"))
    ids = classed.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    worded = classed.join(ids, "root").select("doc_id", "class_id")
    rest = docs.select("doc_id", "text").where(F.col("text").isNull() | ~has_words()).select("doc_id", F.col("doc_id").alias("class_id"))
    return worded.unionByName(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def has_words():
    """Whether a text has a byte that belongs to a word: an ASCII letter or digit, or anything beyond ASCII."""
    return F.coalesce(F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"), F.lit(False))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without near copies: of each group the one with the least doc_id stays, once; same columns.

    Ids that are null come last; among rows of one id the text with the least MD5 stays, of repeated rows one. Null texts
    and texts without words are no copies of anything and stay, each row. Columns of any name are kept as they are, and
    an empty table gives an empty one.
    """
    rows, roots = near_classes(docs, threshold)
    classed = rows.join(roots.withColumnRenamed("node", "key"), "key", "left").select("doc_id", "key", F.coalesce("root", "key").alias("root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    stays = classed.groupBy("root").agg(first.alias("s")).select(F.col("s.doc_id").alias("stay_id"), F.col("s.key").alias("stay_key"))
    same = classed.groupBy("doc_id", "key").agg(F.count("*").alias("n_same"))
    stays = stays.join(same, stays.stay_id.eqNullSafe(same.doc_id) & (stays.stay_key == same.key)).select("stay_id", "stay_key", "n_same")
    worded = F.col("text").isNotNull() & has_words()
    own = docs.where(worded).select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"), F.unhex(F.md5("text")).alias("own_key"))
    kept = own.join(stays, (F.col("own_key") == F.col("stay_key")) & F.col("own_id").eqNullSafe(F.col("stay_id")))
    once = kept.where("n_same = 1").select("row")
    many = kept.where("n_same > 1").dropDuplicates(["own_key", "own_id"]).select("row")
    return once.unionByName(many).select("row.*").unionByName(docs.where(~worded))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
