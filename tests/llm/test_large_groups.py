"""What must stay bounded: many lines, many copies, lists too long to be broadcast."""

import time

import pytest

from tests.conftest import rows
from transitloom.llm import exact_dedup, license_scan, line_dedup
from transitloom.operators import skew


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_of_a_long_text_are_split_once(spark):
    run = "\n".join(f"line {k} of a passage that both documents hold" for k in range(12))
    tail = "\n".join(f"own line {k}" for k in range(100_000))
    docs = spark.createDataFrame([(1, run), (2, f"{run}\n{tail}")], "doc_id bigint, text string")
    start = time.perf_counter()
    found = {row["row"]["doc_id"]: row for row in line_dedup.deduplicated_lines(docs).collect()}
    seconds = time.perf_counter() - start
    assert found[1]["kept_text"] == run and found[2]["kept_text"] == tail
    assert (found[2]["n_lines"], found[2]["n_removed"]) == (100_012, 12)
    assert seconds < 120  # a split for every line would take hours


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_copies_with_and_without_a_broadcast(spark, monkeypatch, broadcast_rows):
    plans = []
    stored = exact_dedup.materialize
    monkeypatch.setattr(
        exact_dedup, "materialize", lambda df, name: plans.append((name, _plan(df))) or stored(df, name))
    texts = [(k, ["a copy", "another", f"text {k}", None, ""][min(k % 7, 4)]) for k in range(200)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = exact_dedup.exact_duplicates(docs, keep="largest", broadcast_rows=broadcast_rows)
    groups = {}
    for key, text in texts:
        groups.setdefault(text or "", []).append(key)
    expected = [
        (key, max(own), len(own), key == max(own)) for own in groups.values() for key in own
    ]
    assert rows(found, "doc_id", "keep_id", "group_size", "kept") == sorted(expected, key=repr)
    (compared,) = [plan for name, plan in plans if name == "collisions"]
    if broadcast_rows:
        assert "BroadcastHashJoin" in compared
    else:
        # Copies are combined where they are read, before any text moves; nothing is joined.
        first_exchange = compared.rindex("Exchange hashpartitioning(digest")
        assert "HashAggregate" in compared[first_exchange:] and "Join" not in compared


@pytest.mark.parametrize("rows_at_most", [1_000_000, 0])
def test_known_digests_by_broadcast_and_by_join(spark, monkeypatch, rows_at_most):
    monkeypatch.setattr(license_scan, "BROADCAST_ROWS", rows_at_most)
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    known = spark.createDataFrame([("L", "Some known line")], "license_id string, text string")
    docs = spark.createDataFrame(
        [(k, "some known LINE\nother text" if k % 3 else "some known line") for k in range(30)],
        "doc_id bigint, text string")
    found = license_scan.scan_licenses(docs, known)
    assert rows(found, "doc_id", "license", "notices", "n_notice_lines") == sorted(
        ((k, None if k % 3 else "L", "L", 1) for k in range(30)), key=repr)
