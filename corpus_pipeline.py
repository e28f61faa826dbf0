"""A training corpus from raw documents in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame; all but the last return the
columns of documents. Null texts, ids and sources, repeated rows, empty tables and more columns are handled as the
operators say.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import cut
from larkspur.llm.dartminhash import keep_one
from larkspur.llm.decontam import find_leaks
from larkspur.llm.langid import fit, identify
from larkspur.llm.mixing import mix_documents
from larkspur.llm.sharding import shard_documents

#: A document goes if the winning language has a smaller share of its letters.
LEAST_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go; lang stays as it was given."""
    found = identify(docs, fit(docs))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(*[f"`{n}`" for n in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("leaks") == 0).select(*[f"`{n}`" for n in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document that is taken twice is there twice."""
    return mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes: doc_id, size, text_crc32, shard, slot."""
    return shard_documents(docs).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL can't express the language model, the signatures and the alignment.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
