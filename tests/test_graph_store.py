"""The stored graph: merged batches, replays, and files that stay as they are."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from transitloom.operators import skew
from transitloom.sources import graph_store
from transitloom.sources.graph_store import StoredEdges, StoredNodes, edge_writer, node_writer
from transitloom.storage import materialize
from transitloom.streaming.sinks import start_fan_out

NODE = "id int, kind string, speed double"
EDGE = "src string, dst string, relation string"


def _files(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def _nodes(spark, given):
    return spark.createDataFrame(given, NODE + ", seen int")


@pytest.fixture
def store(spark, tmp_path):
    return StoredNodes(f"{tmp_path}/nodes", spark.createDataFrame([], NODE).schema, "id", buckets=8)


def test_batches_against_plain_python(spark, store):
    random_ = random.Random(1)
    batches = [
        [(random_.randrange(30), random_.choice("ab"), random_.choice([1.0, None]), k) for k in range(20)]
        for _ in range(4)
    ]
    expected = {}
    for number in (0, 1, 2, 1, 3, 0):
        store.apply(_nodes(spark, batches[number] + [(None, "x", 0.0, 9)]), number, ["seen"])
        for key, kind, speed, _ in batches[number]:
            if number >= expected.get(key, (0, 0, -1))[2]:
                expected[key] = (kind, speed, number)
    assert rows(store.read(spark)) == sorted(((key, *rest) for key, rest in expected.items()), key=repr)


def test_only_touched_buckets_are_rewritten(spark, store):
    store.apply(_nodes(spark, [(k, "a", 1.0, 0) for k in range(100)]), 0, ["seen"])
    before = _files(store.path)
    touched = {row[0] for row in spark.createDataFrame([(3,), (4,)], "id int").select(
        F.pmod(F.xxhash64("id"), F.lit(8))).collect()}
    assert store.apply(_nodes(spark, [(3, "b", 2.0, 0), (4, "b", 2.0, 0)]), 1, ["seen"]) == len(touched) < 8
    after = _files(store.path)
    same = {name for name in before if after.get(name) == before[name]}
    changed = {name.split("bucket=")[1].split("/")[0] for name in set(before) - same}
    assert changed == {str(bucket) for bucket in touched}
    assert store.apply(_nodes(spark, []), 2, ["seen"]) == 0 and _files(store.path) == after
    found = store.read(spark)
    assert found.count() == 100 and found.where("kind = 'b' AND batch = 1").count() == 2


def test_a_batch_applied_twice_is_applied_once(spark, store, tmp_path):
    store.apply(_nodes(spark, [(1, "a", 1.0, 0), (2, "a", None, 0)]), 0, ["seen"])
    store.apply(_nodes(spark, [(2, "b", 2.0, 1), (2, "c", 3.0, 0)]), 1, ["seen"])
    once = rows(store.read(spark))
    store.apply(_nodes(spark, [(2, "b", 2.0, 1), (2, "c", 3.0, 0)]), 1, ["seen"])
    store.apply(_nodes(spark, [(1, "a", 1.0, 0), (2, "a", None, 0)]), 0, ["seen"])
    assert rows(store.read(spark)) == once == [(1, "a", 1.0, 0), (2, "b", 2.0, 1)]
    edges = StoredEdges(f"{tmp_path}/edges", spark.createDataFrame([], EDGE).schema, buckets=4)
    for number, given in ((0, [("a", "b", "R"), ("a", "b", "R")]), (1, [("a", "b", "R"), ("a", "c", "R"), (None, "c", "R")])) * 2:
        edges.apply(spark.createDataFrame(given, EDGE), number)
    assert rows(edges.read(spark)) == [("a", "b", "R", 0), ("a", "c", "R", 1)]


def test_a_hub_is_spread_over_the_buckets(spark, tmp_path):
    edges = StoredEdges(f"{tmp_path}/edges", spark.createDataFrame([], EDGE).schema, buckets=8)
    edges.apply(spark.createDataFrame([("hub", str(k), "R") for k in range(400)], EDGE), 0)
    sizes = [row["count"] for row in edges.read(spark).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 100


def test_a_merge_is_one_shuffle_and_one_write(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(graph_store, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    monkeypatch.setattr(skew, "TASK_ROWS", 50)
    edges = StoredEdges(f"{tmp_path}/edges", spark.createDataFrame([], EDGE).schema, buckets=2)
    for number in (0, 1):
        edges.apply(spark.createDataFrame([(f"v{k}", f"t{k}", "R") for k in range(number * 300, 400)], EDGE), number)
    assert written == ["incoming", "incoming"]
    found = edges.read(spark)
    assert found.count() == found.select("src").distinct().count() == 400
    assert found.where("batch = 1").count() == 0
    files = found.groupBy(F.input_file_name()).count().collect()
    assert len(files) > 2  # a large bucket is several tasks' work


def test_stream_into_the_store(spark, store, tmp_path):
    for part in range(3):
        _nodes(spark, [(k, f"p{part}", 1.0, k) for k in range(part, 6)]).coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/in")
    stream = spark.readStream.schema(NODE + ", seen int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    edges = StoredEdges(f"{tmp_path}/edges", spark.createDataFrame([], EDGE).schema)

    def pairs(batch, epoch_id):
        edge_writer(edges)(batch.selectExpr("'n' AS src", "cast(id AS string) AS dst", "kind AS relation"), epoch_id)

    job = start_fan_out(stream, [node_writer(store, ["seen"]), pairs], f"{tmp_path}/cp", available_now=True)
    job.awaitTermination()
    kinds = dict(rows(store.read(spark), "id", "kind"))
    assert kinds == {0: "p0", 1: "p1", **{k: "p2" for k in range(2, 6)}}
    assert edges.read(spark).count() == 6 + 5 + 4
