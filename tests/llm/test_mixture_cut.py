"""The last pass of a mix tries every row that still fits."""

from pyspark.sql import functions as F

from transitloom.llm import mixture


def test_a_giant_row_does_not_end_the_cut(spark):
    small = [(k, "w " * 100, "a") for k in range(500)]
    other = [(1000 + k, "w " * 100, "b") for k in range(600)]
    # One giant document, under ids that place it before and among the small ones.
    for giant in (-1, -2, -3, -4):
        docs = spark.createDataFrame(
            [(giant, "w " * 60_000, "a"), *small, *other], "doc_id long, text string, source string"
        )
        plan = mixture.plan_mixture(docs, weights=(29, 141), block_words=1 << 20)
        mixed = mixture.placements(plan.sized, plan)
        found = mixed.groupBy("source_key").agg(
            F.sum(F.col("size") * F.size("draws")).alias("taken"), F.first("target").alias("target")
        ).collect()
        assert sorted(row["target"] for row in found) == [29_000, 141_000]
        assert all(abs(row["taken"] - row["target"]) <= 50 for row in found)


def test_rows_that_fit_are_taken_in_key_order(spark):
    def cut(sizes, room):
        rows = [(0, [(k, size) for k, size in enumerate(sizes)], float(room))]
        schema = "place long, rows array<struct<row_key:bigint,size:bigint>>, room double"
        frame = spark.createDataFrame(rows, schema)
        found = frame.select(mixture._filled(F.col("rows"), F.col("room")).alias("cut")).first()["cut"]
        return [(part["low"], part["high"]) for part in found]

    assert cut([60, 10, 10, 50, 5], 29) == [(1, 2), (4, 4)]
    assert cut([60, 10], 9) == [(1, 1)]  # one row too many is nearer than none
    assert cut([60, 30], 9) == []
    assert cut([], 9) == []


def _taken(plan):
    mixed = mixture.placements(plan.sized, plan)
    return mixed.groupBy("source_key").agg(
        F.sum(F.col("size") * F.size("draws")).alias("taken"), F.first("target").alias("target")
    ).collect()


def test_a_million_blocks_of_one_source(spark):
    docs = spark.range(2000).selectExpr(
        "id AS doc_id", "repeat('w ', 1000) AS text", "IF(id < 1000, 'a', 'b') AS source")
    plan = mixture.plan_mixture(docs, block_words=1, block_rows=1 << 20)
    assert {row["blocks"] for row in plan.sources.collect()} == {1_000_000}
    assert all(abs(row["taken"] - row["target"]) <= 500 for row in _taken(plan))


def test_ten_thousand_sources(spark):
    docs = spark.range(30_000).selectExpr(
        "id AS doc_id", "repeat('w ', 10) AS text", "lpad(id % 10000, 5, '0') AS source")
    plan = mixture.plan_mixture(docs, shard_words=200_000)
    found = _taken(plan)
    assert plan.shards == 2 and len(found) == 10_000
    assert all(abs(row["taken"] - row["target"]) <= 5 for row in found)
