"""URL filtering: a blocked Bloom filter of the listed keys in front of an exact hash join.

A listing names a host and a path prefix. Each URL gives one key for every pair of a host suffix and a
path prefix that is as long as some listed one; the filter drops nearly all keys that are not listed and the
exact join removes what passes by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that a key sets in its block of 64 bits.
PROBES = 4
#: Blocks of the filter at most: 2**20 rows of 16 bytes are a proven bound for the broadcast.
MAX_BLOCKS = 1 << 20
#: Listed rules up to which the exact side is broadcast; beyond it the join is salted instead.
MAX_BROADCAST_RULES = 100_000
#: Parts that a hot key is dealt to in the salted join.
SALTS = 32

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, query and fragment."""
    return F.concat(url_host(url), url_path(url))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _mask(key: Column) -> Column:
    h = F.xxhash64(key, F.lit(2))
    out = F.lit(0).cast("long")
    for i in range(PROBES):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def bloom_blocks(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """The filter as rows (block, word): the OR of the masks of the keys that fall into a block."""
    return keys.groupBy(_block(F.col(column), blocks).alias("block")).agg(F.bit_or(_mask(F.col(column))).alias("word"))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Judges each URL by the longest rule that fits it.

    ``rules``: (host, path, verdict). A rule fits its host and all subdomains when the path of the URL starts
    with the rule's; the longest host and path win, then the smaller verdict. Returns the columns of ``pages``
    plus host, path, rule (null where none fits) and verdict (``default`` where none fits); pages that have columns
    of these names lose theirs. Null URLs and URLs without ``://`` have an empty host and path and fit no rule.
    Rules with a null or empty host fit nothing; a null path is the empty prefix. Rows are never dropped or merged.

    Distinct (host, path) pairs are judged once, so a hot host costs one row for each of its paths. Of a host only the last
    labels are looked up, as many as the longest listed host has. The lengths of the listed paths come to the driver: as
    many as the longest listed path has characters at most.
    """
    rules = (
        rules.where("host IS NOT NULL AND host <> ''")
        .select(
            F.translate("host", UPPER, LOWER).alias("rule_host"),
            F.coalesce("path", F.lit("")).alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
        )
        .groupBy("rule_host", "rule_path")
        .agg(F.min("rule_verdict").alias("rule_verdict"))
        .withColumn("key", F.concat_ws("\u0001", "rule_host", "rule_path"))
    )
    stats = rules.agg(F.count("*"), F.collect_set(F.length("rule_path")), F.max(F.size(F.split("rule_host", "[.]")))).first()
    n_rules, lengths, most = stats[0], sorted(stats[1]), stats[2]
    judged = pages.drop("host", "path", "rule", "verdict").withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
    if not n_rules:
        return judged.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    blocks = min(MAX_BLOCKS, max(64, n_rules // 4))
    bloom = F.broadcast(bloom_blocks(rules, "key", blocks))

    labels = F.split("host", "[.]")
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - (most or 0) + 1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")),
        lambda n: F.substring("path", F.lit(1), n),
    )
    places = judged.where("host <> ''").select("host", "path").distinct()
    keys = (
        places.withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(prefixes))
        .withColumn("key", F.concat_ws("\u0001", "suffix", "prefix"))
        .withColumn("block", _block(F.col("key"), blocks))
        .withColumn("mask", _mask(F.col("key")))
    )
    possible = keys.join(bloom, "block").where(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask")).select("host", "path", "key")
    if n_rules <= MAX_BROADCAST_RULES:
        exact = possible.join(F.broadcast(rules), "key")
    else:
        salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        exact = possible.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"])
    best = (
        exact.groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length(F.concat("rule_host", "rule_path")).alias("n"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                    F.col("rule_verdict").alias("verdict"),
                )
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.verdict")
    )
    # URLs without a host fit nothing and stay out of the join, where they would share one key
    hosted = judged.where("host <> ''").join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    bare = judged.where("host = ''").withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    return hosted.unionByName(bare)


#: The rules of the registered query: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def query(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, rest,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS rn
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.rule_verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND f.rn = 1
"""
