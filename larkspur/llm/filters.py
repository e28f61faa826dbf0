"""Filter interaction audit: failure masks of all documents, merged into additive counters of each part, for every order of the filters.

The duplicate filter sorts: texts are range-sorted by fingerprint, and each row is compared with its predecessor, across
the borders of the sorted parts, too.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import cut

#: One letter for each filter; the place of a letter is its bit in a mask.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
CAPITALS, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
DUPLICATE = 1 << FILTERS.index("E")

_SCANNED = "task int, part string, doc_id long, mask int, lead boolean, edge struct<first_text: string, last_text: string, last_least: long, single: boolean>"


def text_mask(text: bytes, points: int) -> int:
    """The bits of the filters that look at one text: A few words, B few distinct words, C many capitals, D symbols."""
    words = text.split()
    n = len(words)
    return (
        (n < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
        | (100 * (len(text) - len(text.translate(None, CAPITALS))) > CAPITAL_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted part: a row for each document, with bit E where a predecessor of equal text has a smaller id, and at the
    end one row about its borders. ``lead``: the row belongs to the first run of equal texts, which may go on from the part before."""
    first = last = least = None
    task, mask, runs = 0, 0, 0
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        texts, ids = b.column("text"), b.column("doc_id")
        raw, points = texts.cast(pa.binary()).to_pylist(), pc.utf8_length(texts).to_pylist()
        same = np.zeros(n, bool)
        same[1:] = pc.equal(texts.slice(1), texts.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        same[0] = runs > 0 and raw[0] == last
        if not runs:
            first, task = raw[0], b.column("task")[0].as_py()
        masks, lead = np.empty(n, np.int32), np.empty(n, bool)
        for i, (id_, equal) in enumerate(zip(ids.to_pylist(), same)):
            if not equal:
                mask, least, runs = text_mask(raw[i], points[i]), id_, runs + 1
            masks[i] = mask | DUPLICATE * (least is not None and id_ is not None and least < id_)
            lead[i] = runs == 1
        last = raw[-1]
        schema = pa.schema([("task", pa.int32()), ("part", b.column("part").type), ("doc_id", pa.int64()), ("mask", pa.int32()), ("lead", pa.bool_()), ("edge", _edge(texts.type))])
        yield pa.RecordBatch.from_arrays([b.column("task"), b.column("part"), ids, pa.array(masks), pa.array(lead), pa.nulls(n, _edge(texts.type))], schema=schema)
    if runs:
        edge = pa.array([{"first_text": first.decode(), "last_text": last.decode(), "last_least": least, "single": runs == 1}], _edge(texts.type))
        yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), *[pa.nulls(1, t.type) for t in schema if t.name not in ("task", "edge")], edge], schema=schema)


def _edge(text: pa.DataType) -> pa.DataType:
    return pa.struct([("first_text", text), ("last_text", text), ("last_least", pa.int64()), ("single", pa.bool_())])


def failure_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask): which filters each document fails, one row for each.

    Null texts are empty, a null source is the part of the empty string. E: another row of equal text has a smaller id; a null
    id is smaller than none and fails for none. Rows that are repeated with their id fail alike. An empty table gives an empty
    table. More columns don't matter.

    Ranges are cut by SHA-256 of the text and id, so that one text of many copies spreads over many parts and the sample of
    the range bounds holds no texts; parts are sorted by fingerprint, text and id. The first run of a part goes on from
    the part before if their bordering texts are equal: the borders, one row a part, give the least id of such a run.
    """
    rows = docs.select(
        F.coalesce("source", F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("fp", F.unhex(F.sha2(F.col("text"), 256)))
    order = F.col("doc_id").asc_nulls_last()
    dealt = rows.repartitionByRange("fp", order).sortWithinPartitions("fp", "text", order).withColumn("task", F.spark_partition_id())
    scanned = cut(dealt.select("task", "part", "doc_id", "text").mapInArrow(_scan, _SCANNED))
    edges = scanned.where("edge IS NOT NULL").select("task", "edge.*")
    by = Window.orderBy("task")
    edges = edges.withColumn("goes_on", F.coalesce(F.col("first_text") == F.lag("last_text").over(by), F.lit(False)))
    own = F.when(~(F.col("single") & F.col("goes_on")), F.struct("last_least"))
    edges = edges.withColumn("origin", F.last(own, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    carried = edges.withColumn("carried", F.lag("origin.last_least").over(by)).where("goes_on").select("task", "carried")
    late = F.col("lead") & F.coalesce(F.col("carried") < F.col("doc_id"), F.lit(False))
    found = scanned.where("edge IS NULL").join(F.broadcast(carried), "task", "left")
    return found.select("doc_id", "part", F.when(late, F.col("mask").bitwiseOR(F.lit(DUPLICATE))).otherwise(F.col("mask")).alias("mask"))


def mask_counters(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, those of quality 1 and those of toxic 1. Of several labels of an id any counts.

    Rows are counted by id before the labels are joined, so that repeated and null ids cost one row a mask and part.
    """
    some = lambda c: F.max((F.col(c) == 1).cast("long"))
    said = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(some("quality").alias("good"), some("toxic").alias("toxic"))
    rows = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n")).join(said, "doc_id", "left")
    marked = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c)
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), marked("good"), marked("toxic"))


def interactions(counters: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What each filter removes at each step of each order of ``filters``, for each part of ``counters`` (part, mask, n, good, toxic).

    Up to six letters: there are as many orders as permutations. Returns part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley (removed, summed over all orders). Of a part all that is needed are the
    documents that survive each set of filters, 2**n numbers.
    """
    n, sets = len(filters), 1 << len(filters)
    survive = lambda c: F.transform(
        F.sequence(F.lit(0), F.lit(sets - 1)),
        lambda s: F.aggregate(F.filter("all", lambda x: x["mask"].bitwiseAND(s) == 0), F.lit(0).cast("long"), lambda a, x: a + x[c]),
    )
    parts = counters.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("all"))
    parts = parts.select("part", *[survive(c).alias(f"s_{c}") for c in ("n", "good", "toxic")])
    shares = []
    for bit in (1 << i for i in range(n)):
        terms = [F.lit(factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())) * (F.get("s_n", F.lit(s)) - F.get("s_n", F.lit(s | bit))) for s in range(sets) if not s & bit]
        shares.append(sum(terms[1:], terms[0]))
    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(filters)])
    rows = parts.withColumn("shares", F.array(*shares)).withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))

    def bits(letters: Column) -> Column:
        out = F.lit(0)
        for i, x in enumerate(filters):
            out = out + F.when(F.instr(letters, x) > 0, 1 << i).otherwise(0)
        return out

    rows = rows.withColumn("done", bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))).withColumn("bit", bits(F.substring("filter_order", F.col("step"), F.lit(1))))
    now, rest = F.col("done").bitwiseOR(F.col("bit")), F.lit(sets - 1).bitwiseXOR(F.col("bit"))
    lost = lambda c: F.get(c, F.col("done")) - F.get(c, now)
    return rows.select(
        "part", "filter_order", "step", F.get("s_n", now).alias("kept"), lost("s_n").alias("removed"),
        (F.get("s_n", F.lit(0)) - F.get("s_n", F.col("bit")) - lost("s_n")).alias("redundant"),
        (F.get("s_n", rest) - F.get("s_n", F.lit(sets - 1))).alias("unique_fails"),
        lost("s_good").alias("good_lost"), lost("s_toxic").alias("toxic_lost"),
        F.get("shares", F.round(F.log2(F.col("bit"))).cast("int")).alias("shapley"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return interactions(mask_counters(failure_masks(docs), labels))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM docs
), failed AS (
  SELECT doc_id, part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
         regexp_matches(text, '[#$%&*|]'), coalesce(least < doc_id, false)] AS f
  FROM worded
), labelled AS (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM (SELECT part, f, (coalesce(g, 0))::INTEGER AS good, (coalesce(t, 0))::INTEGER AS toxic
        FROM failed LEFT JOIN (SELECT doc_id, max((quality = 1)::INTEGER) AS g, max((toxic = 1)::INTEGER) AS t FROM labels GROUP BY doc_id) USING (doc_id))
  GROUP BY part, f
), letters(x) AS (
  VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step::INTEGER AS step, ascii(filter_order[step]) - 64 AS own, [ascii(filter_order[i]) - 64 FOR i IN range(1, step)] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), hit AS (
  SELECT part, filter_order, step, own, n, good, toxic, f[own] AS fails, len([i FOR i IN before IF f[i]]) > 0 AS gone,
         NOT f[own] OR len([i FOR i IN range(1, 6) IF f[i]]) > 1 AS not_alone
  FROM labelled, steps
), found AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN not_alone THEN 0 ELSE n END)::BIGINT AS unique_fails, sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM hit GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM found
"""
