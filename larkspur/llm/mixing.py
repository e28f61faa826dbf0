"""Mixing sources to target weights: hash-random order within each source, distributed prefix sums, exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import cut, numbered

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Ranges that the hash keys of a source are dealt to: the first three hexadecimal digits.
RANGE_DIGITS = 3
#: Sources whose cuts are broadcast; with more of them the documents are joined with salted cuts instead.
MAX_BROADCAST_SOURCES, SALTS = 100_000, 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """Targets of the sources: (source_null, source_key, source_size, target).

    ``sizes``: (source_null, source_key, source_size), one row for each source. Sources in code-point order, the null
    source last, weigh ``weights`` in turn and share ``share`` of all words; none gets more than ``most`` times its
    size and the excess goes to the others by weight. The level of a weight of one rises, from one number of three sums to
    the next, until no further source is full; sources are sorted, numbered and summed on the executors.
    """
    rows = numbered(sizes, "source_null", "source_key")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), F.pmod("nth", F.lit(len(weights))).cast("int") + 1)
    rows = rows.withColumn("w", w).withColumn("most", F.col("source_size") * most)
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, None
    while True:
        capped = F.col("most") < F.lit(level) * F.col("w")
        n, taken, left = rows.agg(F.count_if(capped), F.sum(F.when(capped, F.col("most")).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("w")))).first()
        if n == full or not left:
            break
        level, full = (total * share - taken) / left, n
    target = F.least(F.col("most").cast("double"), F.lit(float(level)) * F.col("w")) if left else F.col("most").cast("double")
    return rows.select("source_null", "source_key", "source_size", target.alias("target"))


def _keyed(docs: DataFrame) -> DataFrame:
    # a null id hashes as the text, so that documents without ids are spread, too
    said = F.md5(F.coalesce("text", F.lit("")))
    name = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), said)))
    return docs.select(
        F.struct("*").alias("row"),
        "doc_id",
        word_count(F.col("text")).alias("size"),
        F.col("source").isNull().alias("source_null"),
        F.coalesce("source", F.lit("")).alias("source_key"),
        F.struct(name.alias("mix_key"), word_count(F.col("text")).alias("size"), said.alias("said")).alias("place"),
        F.substring(name, 1, RANGE_DIGITS).alias("mix_range"),
    )


def plan_mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """How many words of each document the mix takes.

    Returns doc_id, source_null, source_key, place, size, source_size, target, copies and taken (size times copies), and of the
    rows with the same id and text which it is and how many they are (nth, alike).
    A source is read whole as often as its target holds it; the rest of the target goes to its documents in the order
    of the MD5 of their ids, their sizes and the MD5 of their texts, up to the document whose middle passes the budget. Each
    row is a document: of rows that are alike as many are taken as fit, so that a source of repeated ids meets its target, too;
    a null id is hashed by the text. Null texts have no words, the null source is a source, and an empty table gives an
    empty table. A hot source is spread over 16**RANGE_DIGITS ranges of keys.
    """
    rows = _keyed(docs).select("doc_id", "source_null", "source_key", "place", "mix_range", "size")
    ranges = cut(rows.groupBy("source_null", "source_key", "mix_range").agg(F.sum("size").alias("range_size")))
    sizes = ranges.groupBy("source_null", "source_key").agg(F.sum("range_size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    order = Window.partitionBy("source_null", "source_key").orderBy("mix_range")
    starts = ranges.withColumn(
        "start", F.coalesce(F.sum("range_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).join(targets, ["source_null", "source_key"])
    inside = Window.partitionBy("source_null", "source_key", "mix_range").orderBy("place")
    placed = rows.withColumns({
        "before": F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "nth": F.row_number().over(inside) - F.rank().over(inside) + 1,
        "alike": F.count("*").over(inside.rangeBetween(Window.currentRow, Window.currentRow)),
    })
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    extra = (F.col("size") > 0) & (F.col("start") + F.col("before") + F.col("size") / F.lit(2.0) <= rest)
    return (
        placed.join(starts, ["source_null", "source_key", "mix_range"])
        .withColumn("epochs", epochs)
        .withColumn("copies", F.col("epochs") + F.when(extra, 1).otherwise(0))
        .select(
            "doc_id", "source_null", "source_key", "place", "size", "source_size", "target",
            F.col("copies").cast("int").alias("copies"), (F.col("size") * F.col("copies")).cast("long").alias("taken"), "nth", "alike",
        )
    )


def mix_documents(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: each document as often as the plan takes it.

    The texts are not shuffled: the plan leaves one row for each source (epochs and the last place that is taken once
    more), which is broadcast if there are up to MAX_BROADCAST_SOURCES of them; with more the documents are dealt by
    source and one of SALTS salts. Each document is there as often as ``plan_mix`` says; columns keep their names,
    whatever they are. Only where rows of one id and text are taken in part, these are numbered.
    """
    by = ["source_null", "source_key"]
    plan = plan_mix(docs, weights, share, most)
    cuts = plan.groupBy(*by).agg(F.min("copies").alias("epochs"), F.max(F.struct("copies", "place", "nth", "alike")).alias("last"))
    some = F.col("epochs") < F.col("last.copies")
    cuts = cut(cuts.select(*by, "epochs", some.alias("some"), F.col("last.place").alias("last"), F.when(some & (F.col("last.nth") < F.col("last.alike")), F.col("last.nth")).alias("part")))
    n, parts = cuts.agg(F.count("*"), F.count_if(F.col("part").isNotNull())).first()
    keyed, on, sides = _keyed(docs), by, cuts
    if n <= MAX_BROADCAST_SOURCES:
        sides = F.broadcast(cuts)
    else:
        on = [*by, "salt"]
        keyed = keyed.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int"))
        sides = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mixed = keyed.join(sides, on)
    tied = F.coalesce(F.col("part").isNotNull() & (F.col("place") == F.col("last")), F.lit(False))
    extra = F.col("some") & (F.col("size") > 0) & (F.col("place") <= F.col("last"))
    taken = mixed.withColumn("copies", F.col("epochs") + F.when(extra, 1).otherwise(0))
    if parts:
        alike = numbered(mixed.where(tied).select("row", *by, "epochs", "part", F.xxhash64("row").alias("h")), *by, "h")
        first = alike.groupBy(*by).agg(F.min("nth").alias("first"))
        alike = alike.join(F.broadcast(first) if n <= MAX_BROADCAST_SOURCES else first, by).withColumn("copies", F.col("epochs") + F.when(F.col("nth") - F.col("first") < F.col("part"), 1).otherwise(0))
        taken = taken.where(~tied).select("row", "copies").unionByName(alike.select("row", "copies"))
    return taken.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '#' || md5(coalesce(text, '')))) AS k, md5(coalesce(text, '')) AS said
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM rows GROUP BY source
), levels AS (
  SELECT *, row_number() OVER f AS place,
         ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(w) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM per WINDOW f AS (ORDER BY (2 * source_size)::DOUBLE / w, source IS NULL, source)
), fit AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE level * w <= 2 * source_size
), targets AS (
  SELECT source, source_size, coalesce(least((2 * source_size)::DOUBLE, fit.level * w), (2 * source_size)::DOUBLE) AS target
  FROM levels CROSS JOIN fit
), placed AS (
  SELECT doc_id, size, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY k, size, said ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN size > 0 AND before + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
