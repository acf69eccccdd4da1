"""One query per corpus operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.llm import (
    chat_format,
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_extract,
    language_id,
    license_scan,
    line_dedup,
    mixture,
    quality,
    sharding,
    simhash,
    spelling,
)

SHARD_BYTES = 32 << 20
#: A conversation whose texts hold another template's control strings.
AWKWARD_TURNS = (
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    n_hit = decontaminate.hit_words(F.col("spans"))
    return found.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_words"), n_hit).alias("contaminated"),
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixture.plan_mixture(_table(spark, sf_dir, "documents"))
    return mixture.placements(plan.sized, plan).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.size("draws")).alias("taken"),
        F.transform("draws", lambda draw: draw["shard"]).alias("shards"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated_lines(_table(spark, sf_dir, "documents")).select(
        "row.doc_id",
        "n_lines",
        "n_removed",
        F.sha2("kept_text", 256).alias("kept_sha256"),
        F.length("kept_text").cast("bigint").alias("kept_chars"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = license_scan.known_licenses(spark)
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"), known)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"), keep="largest")


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(_table(spark, sf_dir, "documents"), SHARD_BYTES, carry=["doc_id"])
    return sharded.select("row.doc_id", "shard", "size")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = language_id.is_held_out(F.col("doc_id"))
    trees = language_id.learn(documents.where(F.col("doc_id").isNotNull() & ~held_out))
    return language_id.identify(documents, trees, carry=["doc_id"]).select(
        "row.doc_id",
        language_id.is_held_out(F.col("row.doc_id")).alias("held_out"),
        "lang_pred",
        "score",
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    awkward = spark.createDataFrame(list(AWKWARD_TURNS), conversations.schema)
    turns = chat_format.format_turns(conversations.unionByName(awkward))
    return chat_format.read_back(turns)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(_table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.learn(documents, labels.where(~quality.is_held_out(F.col("doc_id"))))
    score = F.col("score")
    return quality.score_quality(documents, model, carry=["doc_id"]).select(
        "row.doc_id",
        quality.is_held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (score >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.runs(_table(spark, sf_dir, "documents"))
    # Deleting a letter makes no run longer: shorter ones give no words.
    long_enough = found.where(F.length("run") >= spelling.LEAST_LENGTH)
    return spelling.group_variants(spelling.vocabulary(spelling.misspelt(long_enough))).words


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    repaired = conversation_repair.repair(conversation_repair.damage(conversations))
    found = repaired.reports.join(conversation_repair.text_digests(repaired), "talk", "left")
    zero = F.lit(0).cast("bigint")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    every = conversations.select("conv_id").distinct().withColumnRenamed("conv_id", "original")
    return every.join(found, F.expr("original <=> conv_id"), "left").select(
        F.col("original").alias("conv_id"),
        *[F.coalesce(name, zero).alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def corpus_queries() -> dict:
    """The queries by name."""
    queries = (
        op1_decontaminate, op2_mix_sources, op3_line_dedup, op4_license_scan, op5_exact_dedup,
        op6_shard, op7_language_id, op8_simhash, op9_chat_format, op10_html_extract,
        op11_quality, op12_spelling_variants, op13_conversation_repair,
    )
    return {query.__name__: query for query in queries}
