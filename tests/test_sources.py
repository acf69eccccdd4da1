import pytest

from tests.conftest import rows
from transitloom import storage
from transitloom.plans import testdata
from transitloom.schemas import PREDICTIONS, TRANSPORT_DATA
from transitloom.sources import catalog, database, files

SF = "/root/testdata/sf0.001"


def test_jdbc_reader_options():
    whole = database.jdbc_options("jdbc:x", "t", properties={"user": "u"})
    assert whole == {"user": "u", "url": "jdbc:x", "fetchsize": "10000", "dbtable": "t"}
    text = database.jdbc_options("jdbc:x", query="SELECT 1")
    assert text["query"] == "SELECT 1" and "dbtable" not in text
    parts = database.jdbc_options("jdbc:x", query="SELECT 1", partition=("id", 0, 100, 16))
    assert parts["dbtable"] == "(SELECT 1) AS source_rows" and "query" not in parts
    assert (parts["partitionColumn"], parts["numPartitions"]) == ("id", "16")
    for wrong in ({}, {"table": "t", "query": "q"}):
        with pytest.raises(ValueError):
            database.jdbc_options("jdbc:x", **wrong)


def test_jdbc_writer_options():
    options = database.write_options("jdbc:x", "t", {"password": "p"}, "name VARCHAR(10)")
    assert options == {
        "password": "p", "url": "jdbc:x", "dbtable": "t", "batchsize": "10000",
        "createTableColumnTypes": "name VARCHAR(10)"}


def test_micro_batches_carry_their_number(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(
        database, "write_jdbc", lambda df, url, table, **options: seen.append((df, url, table)))
    frame = spark.createDataFrame([(1,)], "a int")
    database.foreach_batch_jdbc("jdbc:x", "t")(frame, 7)
    database.foreach_batch_jdbc("jdbc:x", "t", epoch_column=None)(frame, 7)
    assert [rows(df) for df, _, _ in seen] == [[(1, 7)], [(1,)]]
    assert seen[0][1:] == ("jdbc:x", "t")


def test_csv_keeps_clock_times_as_text(spark, tmp_path):
    row = ("t", "r", "08:30", "2025-01-31", None, 3, 1, "bus", 1, "1", 7, 30, 1.5, None, -4, 60.1,
           24.9, "2025-01-31T06:30:00Z", 1738305000, "1010", 12.0, "GPS", None)
    frame = spark.createDataFrame([row], TRANSPORT_DATA)
    assert files.write_csv(frame, f"{tmp_path}/facts", single_file=True)
    assert rows(files.read_transport_csv(spark, f"{tmp_path}/facts/*.csv")) == [row]


def test_compressed_csv_is_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 100)
    row = ("t", None, "08:30", "2025-01-31", "a, \"b\"", 3, None, "bus", 1, "1", 7, 30, 1.5, None, -4, 60.1,
           24.9, "2025-01-31T06:30:00Z", 1738305000, "1010", 12.0, "GPS", None)
    frame = spark.createDataFrame([row] * 250, TRANSPORT_DATA).coalesce(1)
    for name, options in (("plain", {}), ("small", {"compression": "gzip"})):
        assert files.write_csv(frame, f"{tmp_path}/{name}", **options)
        assert rows(files.read_transport_csv(spark, f"{tmp_path}/{name}")) == [row] * 250
    plain, small = (sorted((tmp_path / name).glob("part-*")) for name in ("plain", "small"))
    assert [len(plain), len(small)] == [1, 3] and all(file.name.endswith(".csv.gz") for file in small)
    assert sum(file.stat().st_size for file in small) * 5 < plain[0].stat().st_size


def test_a_constant_time_is_told_once(spark, tmp_path):
    frame = spark.range(3).selectExpr(
        "id", "current_timestamp() AS `made.at`", "timestamp '2024-03-01 10:00:00.123456' AS early",
        "if(id = 1, NULL, timestamp_micros(id * 3000000000000123)) AS at", "date '2024-03-01' AS day",
        "timestamp_ntz '2024-03-01 10:00:00' AS ntz")
    plan = files._with_time_text(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format") == 1  # the time that differs between rows
    frame = frame.drop("made.at").coalesce(1)
    for zone in ("UTC", "Asia/Kolkata"):
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            frame.write.mode("overwrite").option("header", True).csv(f"{tmp_path}/spark")
            assert files.write_csv(frame, f"{tmp_path}/own")
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        own, spark_own = (next((tmp_path / name).glob("part-*.csv")).read_text() for name in ("own", "spark"))
        assert own == spark_own and own.count("\n") == 4


def test_empty_frames_can_be_skipped(spark, tmp_path):
    empty = spark.createDataFrame([], PREDICTIONS)
    assert not files.write_csv(empty, f"{tmp_path}/p", skip_empty=True)
    assert not storage.path_exists(spark, f"{tmp_path}/p")
    assert files.write_csv(empty, f"{tmp_path}/p")
    assert files.read_predictions_csv(spark, f"{tmp_path}/p").isEmpty()


def test_date_filter_prunes_partitions(spark, tmp_path):
    facts = testdata.facts(spark, SF).drop("status", "timestamp")
    files.write_facts(facts, f"{tmp_path}/facts")
    stored = spark.read.parquet(f"{tmp_path}/facts").where("start_date = '2024-01-10'")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start_date" in plan
    assert stored.count() == facts.where("start_date = '2024-01-10'").count() > 0


def test_table_is_created_once_and_appended(spark, tmp_path):
    for _ in range(2):
        catalog.ensure_table(spark, "predictions_test", location=f"{tmp_path}/t")
        row = spark.range(3).selectExpr("cast(id as int) AS vehicle_id")
        missing = [f"cast(NULL as {f.dataType.simpleString()}) AS {f.name}"
                   for f in PREDICTIONS if f.name != "vehicle_id"]
        catalog.append_table(row.selectExpr("vehicle_id", *missing), "predictions_test")
    table = catalog.read_view(spark, "predictions_test")
    assert table.schema == PREDICTIONS
    assert rows(table, "vehicle_id") == [(0,), (0,), (1,), (1,), (2,), (2,)]
    spark.sql("DROP TABLE predictions_test")


def test_view_is_readable_by_name(spark):
    catalog.register_view(spark.range(2), "some_view")
    assert rows(catalog.read_view(spark, "some_view")) == [(0,), (1,)]


class _Conf(dict):
    pass


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master, **settings):
        self.conf = _Conf(settings)
        self.sparkContext = _Context(master)


def test_shared_folder_follows_the_setting(spark):
    named = _Session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs:///shared/folder/"})
    assert storage.shared_dir(named) == "hdfs:///shared/folder"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(_Session("spark://host:7077"))
    assert storage.new_path(spark, "x") != storage.new_path(spark, "x")
