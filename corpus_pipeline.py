"""A training corpus from the documents table: five stages, each an operator of ``llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.llm import decontaminate, language_id, mixture, sharding, simhash
from transitloom.storage import discard, materialize

SHARD_BYTES = 32 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language the corpus teaches; those of none, or of none clearly, go.

    Null and empty texts and those without a letter go. Rows of a null id teach nothing but may
    stay; repeated rows stay or go together. An empty table stays empty.
    """
    held_out = language_id.is_held_out(F.col("doc_id"))
    trees = language_id.learn(docs.where(F.col("doc_id").isNotNull() & ~held_out))
    return language_id.drop_unidentified(docs, trees)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one of smallest id, of several rows of that id the
    one whose text has the smallest hash.

    Null and empty texts are one group; a null id is smaller than any other. Repeated rows leave
    one. An empty table stays empty.
    """
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold benchmark passages: a twentieth of their words or more.

    Null and empty texts hold none and stay; repeated rows stay or go together. An empty table of
    documents stays empty, an empty benchmark takes nothing away.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    A null source is one of its own, last in order. Texts without words, null ones included, have
    no size and are not drawn. Rows alike in id and text are taken alike; of equal sizes the order
    of a hash decides. An empty table stays empty.
    """
    return mixture.mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard they belong to.

    Null ids and texts have hashes of their own; equal rows share a shard until they exceed its
    size, then they lie in several. A column ``shard`` of the documents gives way to the new one.
    An empty table has no shards.
    """
    sharded = sharding.shard(docs, SHARD_BYTES)
    names = [name for name in docs.columns if name != "shard"]
    return sharded.select(*[F.col("row")[name].alias(name) for name in names], "shard")


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_text),
    ("source_mix", mix_sources),
    ("sharding", assign_shards),
]

#: Learnt models and Spark's hashes have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is stored and read again.

    A stored result goes when the next one is there: at most two lie in the shared folder.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
