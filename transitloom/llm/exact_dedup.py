"""Exact duplicates: 128-bit content hash, stable survivor, byte comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.llm.frames import column
from transitloom.operators.skew import BROADCAST_ROWS
from transitloom.storage import materialize


def _md5(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
    digest: Callable[[Column], Column] = _md5,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are grouped by a 128-bit hash of the text (after ``normalise``, if given). Inside
    groups of more than one row the texts themselves are compared: they are grouped as
    bytes, which combines copies before the shuffle, so a group of any size stays spread
    over the tasks that read it. A hash shared by different texts is split again.

    The list of repeated hashes tells which texts to compare while it has ``broadcast_rows`` at
    most and is broadcast. Beyond that all texts are grouped, each once per task that reads it.

    ``keep`` is ``smallest`` or ``largest``: which ``doc_id`` of equal texts stays.

    * A null text counts as empty; empty texts are equal to each other.
    * A null id is smaller than any other and stays only where all ids are null.
    * Of repeated rows (same id, same text) exactly one is ``kept``.
    * Extra columns are ignored; an empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep!r}")
    text = F.coalesce(column(text_col), F.lit(""))
    rows = documents.select(
        column(id_col).alias("doc_id"), (normalise(text) if normalise else text).alias("text")
    )
    keys = materialize(
        rows.select(
            "doc_id",
            digest(F.col("text")).alias("digest"),
            F.sha2("text", 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "content-keys",
    )
    repeated = materialize(
        keys.groupBy("digest").count().where("count > 1").select("digest"), "repeated-digests"
    )
    hashed = rows.withColumn("digest", digest(F.col("text")))
    if repeated.count() <= broadcast_rows:
        hashed = hashed.join(F.broadcast(repeated), "digest", "left_semi")
    variants = hashed.groupBy("digest", "text").count()
    collided = materialize(
        variants.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1"), "collisions"
    )
    # Texts that differ under one hash are told apart by a second, independent hash.
    named = keys.join(collided, "digest", "left").select(
        "doc_id", "row_no", "digest", "text_sha256",
        F.when(F.col("texts").isNotNull(), F.col("text_sha256")).otherwise("").alias("variant"),
    )
    pick, pick_row = (F.min, F.min_by) if keep == "smallest" else (F.max, F.max_by)
    groups = named.groupBy("digest", "variant").agg(
        pick("doc_id").alias("keep_id"),
        F.coalesce(pick_row("row_no", "doc_id"), F.min("row_no")).alias("keep_row"),
        F.count("*").alias("group_size"),
    )
    # Stored, the groups have a shuffle of their own, and the join can split a large group.
    groups = materialize(groups, "content-groups")
    return named.join(groups, ["digest", "variant"]).select(
        "doc_id", "keep_id", "group_size",
        (F.col("row_no") == F.col("keep_row")).alias("kept"),
        "text_sha256",
    )
