"""The hot-key paths give the same rows as the plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from transitloom.operators import graph, ordering, skew, traversal, trip_join
from transitloom.operators.ordering import batch_id, next_in_group, with_rank
from transitloom.operators.skew import HotKeys, count_pairs, hot_keys, skew_join
from transitloom.operators.trip_join import join_trips_vehicles
from transitloom.plans import testdata
from transitloom.storage import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """2000 rows of which a third has key 1, some of them exact copies, and some no key."""
    draw = random.Random(3)
    data = [
        (1 if i % 3 == 0 else draw.choice([None, *range(2, 60)]), draw.randrange(300))
        for i in range(2000)
    ]
    return spark.createDataFrame(data, "k int, v int").repartition(6)


def test_hot_keys_are_found_with_their_counts(skewed):
    expected = skewed.where("k = 1").count()
    assert rows(hot_keys(skewed, ["k"], 100, 1 / 50).table) == [(1, expected)]
    assert not hot_keys(skewed, ["k"], 10_000)


def test_a_key_of_a_small_share_is_split_too(spark):
    frame = spark.range(200_000).select(
        F.when(F.col("id") % 2000 == 0, -1).otherwise(F.col("id")).alias("k"), "id"
    )
    found = hot_keys(frame, ["k"], 100)
    assert rows(found.table) == [(-1, 100)]
    right = frame.where("id % 1000 = 0").select("k", F.col("id").alias("w")).where("k <> -1 OR w = 0")
    joined = skew_join(frame, right, ["k"], "left", 100, unique_right=True)
    assert "_left_salt" in joined._jdf.queryExecution().toString()
    assert rows(joined.where("w IS NOT NULL")) == rows(frame.join(right, "k"))


@pytest.mark.parametrize("hot_rows", [8, 100])
def test_inner_join_with_hot_keys_on_both_sides(spark, skewed, hot_rows):
    right = skewed.select("k", F.col("v").alias("w")).where("w < 60")
    expected = rows(skewed.join(right, "k"))
    joined = skew_join(skewed, right, ["k"], "inner", hot_rows, 1 / 1024)
    assert joined.columns == ["k", "v", "w"]
    assert rows(joined) == expected


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_joins_with_unique_right_side(spark, skewed, how):
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 30)], "k int, w int")
    expected = rows(skewed.join(right, "k", how))
    joined = skew_join(skewed, right, ["k"], how, 8, 1 / 1024, unique_right=True)
    assert rows(joined) == expected


def test_other_joins_need_a_unique_right_side(skewed):
    with pytest.raises(ValueError):
        skew_join(skewed, skewed, ["k"], "left")


def test_hot_rows_are_spread_over_salts(spark, skewed):
    right = spark.createDataFrame([(k, k) for k in range(60)], "k int, w int")
    joined = skew_join(skewed, right, ["k"], "left", 40, 1 / 1024, unique_right=True)
    plan = joined._jdf.queryExecution().toString()
    assert "_left_salt" in plan


def test_pairs_of_a_join_are_counted(spark, skewed):
    right = skewed.where("v < 60")
    assert count_pairs(skewed, right, ["k"]) == skewed.join(right, "k").count()
    assert count_pairs(skewed, right.where("k IS NULL"), ["k"]) == 0


def test_few_rows_with_many_pairs_are_joined_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(trip_join, "TASK_PAIRS", 1000)
    events = testdata.event_rows(spark, SF).withColumn("ts", F.date_trunc("month", "ts"))
    trips, vehicles = testdata.trip_rows(events).coalesce(1), testdata.vehicle_rows(events).coalesce(1)
    joined = join_trips_vehicles(trips, vehicles)
    pairs = joined.count()
    assert pairs > 1000 and joined.rdd.getNumPartitions() == -(-pairs // 1000)
    sides = trips.select("route_id", "start_time", "start_date").alias("t").join(
        vehicles.select("journey_id", "start_time", "start_date", F.col("route").alias("route_id")),
        ["route_id", "start_time", "start_date"],
    )
    keys = ["route_id", "start_time", "start_date", "journey_id"]
    assert rows(joined, *keys) == rows(sides, *keys)


def test_facts_of_a_vehicle_row_follow_each_other(spark):
    name = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.conf.set(name, -1)
    try:
        events = testdata.event_rows(spark, SF).withColumn("ts", F.date_trunc("month", "ts"))
        joined = join_trips_vehicles(testdata.trip_rows(events), testdata.vehicle_rows(events))
        found = [row[0] for row in joined.select("journey_id").collect()]
    finally:
        spark.conf.unset(name)
    runs = sum(one != before for one, before in zip(found, [None, *found], strict=False))
    assert len(found) > 2 * runs and runs == len(set(found))


def test_trip_join_with_hot_start(spark):
    rows_ = testdata.event_rows(spark, SF).withColumn(
        "ts", F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-05").cast("timestamp_ntz")).otherwise(F.col("ts"))
    ).withColumn("k", F.when(F.col("event_id") % 3 == 0, 5).otherwise(F.col("k")))
    trips, vehicles = testdata.trip_rows(rows_), testdata.vehicle_rows(rows_)
    plain = join_trips_vehicles(trips, vehicles).drop("processed_time")
    salted = join_trips_vehicles(trips, vehicles, hot_rows=20, hot_share=1 / 100).drop("processed_time")
    assert plain.count() > 1000
    assert rows(salted) == rows(plain)


def test_rank_is_the_position_in_the_total_order(spark, skewed):
    frame = skewed.withColumn("id", F.monotonically_increasing_id())
    found = with_rank(frame, ["k", "v", "id"]).orderBy("rank").collect()
    assert [row["rank"] for row in found] == list(range(2000))
    order = [(row.k is not None, row.k or 0, row.v, row.id) for row in found]
    assert order == sorted(order)


def test_batches_are_disjoint_and_full(spark):
    events = testdata.table(spark, SF, "events").select("event_id", "ts")
    sizes = batch_id(events, ["ts", "event_id"], 128).groupBy("batch_id").count().orderBy("batch_id").collect()
    counts = [row["count"] for row in sizes]
    assert set(counts[:-1]) == {128} and sum(counts) == events.count()


def test_next_row_in_hot_group(spark, skewed):
    visits = skewed.dropna().distinct()
    plain = next_in_group(visits, "k", ["v"], "v", "following")
    hot = HotKeys(spark.createDataFrame([(1,), (7,)], "k int"), 2)
    ranked = next_in_group(visits, "k", ["v"], "v", "following", hot)
    assert rows(ranked, *plain.columns) == rows(plain)


@pytest.mark.parametrize("order", [None, "timestamp_seconds"])
def test_stop_succession_with_hot_trips(spark, order):
    facts = testdata.graph_facts(spark, SF).withColumn(
        "trip_id", F.when(F.col("order_key") % 3 == 0, F.lit(77)).otherwise(F.col("trip_id"))
    )
    plain = graph.stop_precede(facts, order)
    hot = graph.stop_precede(facts, order, hot_rows=50, hot_share=1 / 100)
    assert rows(hot) == rows(plain)
    if order is None:
        visits = graph.trip_stop_edges(facts).groupBy("trip_id").count()
        per_trip = visits.select("trip_id", (F.col("count") - 1).alias("n")).where("n > 0")
        assert rows(hot.groupBy("trip_id").agg(F.count("*").alias("n"))) == rows(per_trip)


def test_frequent_value_is_ranked_over_several_partitions(spark, monkeypatch):
    stored = []

    def keep(df, name):
        stored.append(materialize(df, name))
        return stored[-1]

    monkeypatch.setattr(ordering, "materialize", keep)
    frame = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("v"), "id"
    ).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = with_rank(frame, ["v"]).orderBy("rank").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [row["rank"] for row in found] == list(range(20_000))
    assert [row.v for row in found] == sorted(row.v for row in found)
    part = F.shiftright("_place", 33)
    assert stored[0].where("v = 7").select(part).distinct().count() > 2


def test_a_bitmap_keeps_all_that_join_and_little_else(spark):
    frame = spark.range(20_000).select(F.concat(F.lit("T_"), "id").alias("src"), "id")
    frame = frame.unionByName(frame.where("id < 100")).unionByName(spark.sql("SELECT CAST(NULL AS STRING) src, -1L id"))
    ids = frame.where("id % 10 = 3").select("src").distinct()
    kept = skew.maybe_in(frame, ids, "src", ids.count())
    assert kept.columns == frame.columns
    assert rows(kept.where("id % 10 = 3")) == rows(frame.where("id % 10 = 3"))
    assert kept.count() < 2_010 + 18_000 / 8
    assert skew.maybe_in(frame, ids.limit(0), "src", 0).isEmpty()


def test_neighbourhoods_shuffle_only_links_that_may_join(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(
        traversal, "maybe_in", lambda *args: kept.append(skew.maybe_in(*args)) or kept[-1])
    pairs = [(k, k + 1000) for k in range(1000)] + [(0, k) for k in range(1, 50)]
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    seeds = spark.createDataFrame([(0,)], "id bigint")
    found = traversal.neighborhood(edges, seeds, 2, broadcast_rows=10)
    assert rows(found) == sorted(
        [(0, 0), (1000, 1)] + [(k, 1) for k in range(1, 50)] + [(1000 + k, 2) for k in range(1, 50)], key=repr)
    # Of the 2,098 links both ways few go to the join.
    assert len(kept) == 1 and kept[0].count() < 99 + 50 + 200
