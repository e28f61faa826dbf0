"""Source divergence audit: how far apart the sources of a language are, term by term, in exact integers.

Terms with the same sparse vector of source counts are one column: each pair of sources is evaluated once for each distinct
vector and multiplied by the number of its terms. Zero counts are never written out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import cut, discard, numbered

#: A probability of one in the integers of this audit (a fixed value of the measure).
SCALE = 1_000_000_000
#: Documents of a language that a term must be in, and the terms of a group that are ranked.
MIN_DOCS, TOP = 3, 200
#: Counted terms that a task holds before it hands them on, and bytes of a text that are split at once.
HELD, PIECE = 200_000, 1 << 20
#: Groups up to which their table is broadcast; beyond it is dealt with salts.
MAX_BROADCAST_GROUPS, SALTS = 100_000, 32

# A-Z to lower case; bytes of other ASCII characters than letters end a term, bytes from 0x80 belong to one.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_COUNTED = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about PIECE bytes that end between two terms."""
    text, start = text.translate(_FOLD), 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task: (lang, source, term, n, docs), and one row without a term for each group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush():
        rows = [(lang, source, t, k, d[t]) for (lang, source), (n, d) in held.items() for t, k in n.items()] + [(*g, None, 0, 0) for g in held]
        columns = list(zip(*rows)) or [[]] * 5
        held.clear()
        terms = pa.array(columns[2], pa.binary()).cast(pa.string())
        arrays = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), terms, pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

    for b in batches:
        for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            own = set()
            for words in terms_of(text):
                n.update(words)
                own.update(words)
            docs.update(own)
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield flush()
    if held:
        yield flush()


def shared(n: Column, total: Column) -> Column:
    """The scaled probability of a term of ``n`` occurrences among ``total`` smoothed ones."""
    up = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", up, total.cast("decimal(19,0)"))


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _beside(rows: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """Each row with all groups of its language."""
    if few:
        return rows.join(F.broadcast(groups), "lang")
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")).join(salted, ["lang", "salt"]).drop("salt")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) for each group of a language and a source.

    A term is a run of letters and of characters beyond ASCII, A-Z lower-cased; a language keeps those in at least
    ``min_docs`` of its documents, V of them. p is 1 + floor(SCALE (count + 1) / (N + V)) with N, the count of all kept terms in
    the group or the language, and f(p, q) is floor((p - q)**2 / q). Part ``pair``: f of the group against each other
    source of the language, summed over all kept terms; 0 without kept terms. Part ``term``: f against the language for terms
    of the group with p > q, the first ``top`` only. Null texts, languages and sources are empty strings; each row is a
    document, repeated or not; ids don't matter. An empty table gives an empty table.

    Counts are combined in each task first, so that a hot group or term is one row a task. A vector has an entry for
    each source at most, the square root of what the pairs of its language return. For terms that one or both of a pair lack,
    f depends on one count or none: such sums come from the number of terms of each count.
    """
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]
    counted = cut(docs.select(*blank).mapInArrow(_count, _COUNTED))
    terms = (
        counted.where("term IS NOT NULL").repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("vector"))
    )
    kept = cut(terms.where(F.col("docs") >= min_docs).drop("docs"))
    names = numbered(counted.where("term IS NULL").select("lang", "source").distinct(), "lang", "source")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    sizes = kept.select("lang", F.explode("vector").alias("e")).groupBy("lang", "e.source").agg(F.sum("e.n").alias("own_n"))
    v = F.coalesce("v", F.lit(0))
    groups = cut(
        names.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", F.col("nth").alias("g"), v.alias("v"), (F.coalesce("own_n", F.lit(0)) + v).alias("own_all"), (F.coalesce("lang_n", F.lit(0)) + v).alias("lang_all"),
        ).withColumn("p0", F.when(F.col("v") > 0, shared(F.lit(0).cast("long"), F.col("own_all"))))
    )
    discard(counted)
    few = groups.count() <= MAX_BROADCAST_GROUPS

    vectors = cut(kept.groupBy("lang", "vector").agg(F.count("*").alias("times")))
    entries = vectors.withColumn("vid", F.monotonically_increasing_id()).select("lang", "vid", "times", F.inline("vector"))
    entries = cut(entries.join(groups, ["lang", "source"]).select("lang", "vid", "times", "g", shared(F.col("n"), F.col("own_all")).alias("p"), "p0"))
    pairs = _pairs(entries, groups, few)
    g, h = (groups.select(F.col("g").alias(a), "lang", F.col("source").alias(b)) for a, b in (("g", "source"), ("h", "item")))
    pairs = pairs.join(g, "g").join(h.drop("lang"), "h").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    q = shared(F.col("total"), F.col("lang_all"))
    own = kept.select("lang", "term", "total", F.inline("vector")).join(groups, ["lang", "source"]).select("lang", "source", "term", shared(F.col("n"), F.col("own_all")).alias("p"), q.alias("q"))
    own = own.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(best))
    return ranked(pairs).unionByName(ranked(own).where(F.col("rank") <= top))


def _pairs(entries: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """(g, h, value) of all ordered pairs of groups of a language.

    With zero counts p0 and q0, f(p, q) is the sum of what both counts do together, what each does alone and f(p0, q0):
    the first is evaluated where a vector has both, once for each distinct vector, the second for each count of a group, and
    the last for each pair.
    """
    vectors = entries.groupBy("lang", "vid", "times").agg(F.collect_list(F.struct("g", "p", "p0")).alias("x"))
    both = vectors.select("times", F.explode("x").alias("a"), "x").select("times", "a", F.explode("x").alias("b")).where("a.g <> b.g")
    f = lambda p, q: apart(F.col(p), F.col(q))
    together = f("a.p", "b.p") - f("a.p", "b.p0") - f("a.p0", "b.p") + f("a.p0", "b.p0")
    both = both.select(F.col("a.g").alias("g"), F.col("b.g").alias("h"), (F.col("times") * together).alias("value"))

    others = groups.select("lang", F.col("g").alias("o"), F.col("p0").alias("q0"))
    counts = entries.groupBy("lang", "g", "p", "p0").agg(F.sum("times").alias("times"))
    alone = _beside(counts, others, few).where("g <> o")
    ahead, behind = F.col("times") * (f("p", "q0") - f("p0", "q0")), F.col("times") * (f("q0", "p") - f("q0", "p0"))
    alone = alone.select(F.inline(F.array(F.struct("g", F.col("o").alias("h"), ahead.alias("value")), F.struct(F.col("o").alias("g"), F.col("g").alias("h"), behind.alias("value")))))
    none = _beside(groups.select("lang", "g", "p0", "v"), others, few).where("g <> o")
    none = none.select("g", F.col("o").alias("h"), F.coalesce(F.col("v") * f("p0", "q0"), F.lit(0)).alias("value"))
    return both.unionByName(alone).unionByName(none).groupBy("g", "h").agg(F.sum("value").alias("value"))


def query(spark, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), seen AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS lang_n FROM kept GROUP BY lang
), groups AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(own_n, 0) AS own_n, coalesce(lang_n, 0) AS lang_n
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS own_n FROM seen GROUP BY ALL) USING (lang, source) LEFT JOIN langs USING (lang)
), p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1::HUGEINT + (1000000000 * (coalesce(n, 0) + 1)) // (own_n + v) AS p,
         1::HUGEINT + (1000000000 * (total + 1)) // (lang_n + v) AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN seen USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::HUGEINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
