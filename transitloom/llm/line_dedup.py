"""Line dedup by a suffix array over line ids, built with distributed prefix doubling.

The lines of all documents, in order, are one sequence. Prefix doubling ranks the runs of
1, 2, 4, ... lines that start at each place; a rank is the place of the run among all
different runs of its length, so runs are equal exactly if their ranks are. The ranks of a
power of two and of the same length counted back from the end name the interval of the
suffix array in which a run of any length lies: all suffixes whose common prefix is that
long. Its first member in document order is the original, the others are later copies.

A repeated run counts if it has ``min_words`` words. Every line of such a run lies in one
that cannot be shortened at its end, or at its start, without falling below that. Only
those two runs per line have to be looked up, and they have at most ``min_words`` lines:
the number of doublings depends on the parameter, not on the length of the copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitloom.functions.values import once
from transitloom.llm.frames import column, content_key
from transitloom.llm.mixture import word_count
from transitloom.operators.ordering import with_rank
from transitloom.storage import materialize

_BLANKS = "\t\n\x0b\f\r "


def _document_key(id_col: str, text_col: str) -> list[Column]:
    return [column(id_col).alias("doc_id"), F.xxhash64(column(text_col)).alias("text_key")]


def _lines(text: Column) -> Column:
    """The lines of a text, blanks around them taken off."""
    return F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_BLANKS)))


def _active_lines(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines that occur more than once: ``pos, segment, doc_id, text_key, line, words, rank``.

    ``pos`` numbers them in document order. Lines of one document with no other line but
    blank ones between them have the same ``segment``.
    """
    filled = F.filter(
        F.transform(
            _lines(column(text_col)), lambda line, at: F.struct(at.alias("line"), line.alias("text"))
        ),
        lambda entry: entry["text"] != "",
    )
    lines = (
        documents.select(*_document_key(id_col, text_col), F.posexplode(filled).alias("at", "entry"))
        .select(
            "doc_id", "text_key", "at", "entry.line",
            word_count(F.col("entry.text")).alias("words"),
            *content_key(F.col("entry.text")),
        )
    )
    lines = materialize(lines, "lines")
    key = ["key_a", "key_b"]
    repeated = lines.groupBy(*key).count().where("count > 1").select(*key)
    ranked = materialize(with_rank(repeated, key, "rank"), "line-ranks")
    found = (
        lines.join(ranked, key)
        .drop(*key)
        # Rows alike in id and text are one document.
        .dropDuplicates(["doc_id", "text_key", "at"])
        .withColumn("no_id", F.col("doc_id").isNull())
    )
    placed = with_rank(found, ["no_id", "doc_id", "text_key", "at"], "pos")
    return placed.withColumn("segment", F.col("at") - F.col("pos")).drop("no_id", "at")


def _shortest_runs(active: DataFrame, min_words: int) -> DataFrame:
    """``start, length`` of the runs of ``min_words`` words or more that cannot be shortened
    at their end or cannot be shortened at their start."""
    segments = active.groupBy("doc_id", "text_key", "segment").agg(
        F.array_sort(F.collect_list(F.struct("pos", "words"))).alias("lines"),
        F.sum("words").alias("total"),
    )

    def search(batches):
        for batch in batches:
            starts, lengths = [], []
            for lines in batch.column("lines"):
                lines = lines.values
                first = lines.field("pos")[0].as_py()
                upto = np.concatenate([[0], np.cumsum(lines.field("words").to_numpy())])
                size = len(upto) - 1
                # From each start the first end, and to each end the last start.
                ends = np.searchsorted(upto, upto[:-1] + min_words)
                begin = np.searchsorted(upto, upto[1:] - min_words, "right") - 1
                own = np.concatenate([np.arange(size), begin])
                stop = np.concatenate([ends, np.arange(1, size + 1)])
                fits = (own >= 0) & (stop <= size)
                runs = np.unique(np.stack([own[fits], stop[fits]]), axis=1)
                starts.append(first + runs[0])
                lengths.append(runs[1] - runs[0])
            none = [np.empty(0, dtype=np.int64)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(starts or none).astype(np.int64)),
                    pa.array(np.concatenate(lengths or none).astype(np.int64)),
                ],
                names=["start", "length"],
            )

    long = segments.where(F.col("total") >= min_words).select("lines")
    return long.mapInArrow(search, "start bigint, length bigint")


def _doubled(ranks: DataFrame, size: int) -> DataFrame:
    """Ranks of the runs of ``2 * size`` lines that occur more than once, from those of ``size``."""
    window = Window.partitionBy("doc_id", "text_key", "segment").orderBy("pos")
    ahead = F.first("rank").over(window.rangeBetween(size, size))
    pairs = ranks.withColumn("next", ahead).where("next is not null")
    repeated = pairs.groupBy("rank", "next").count().where("count > 1").select("rank", "next")
    ranked = with_rank(repeated, ["rank", "next"], "longer")
    return pairs.join(ranked, ["rank", "next"]).select(
        "pos", "segment", "doc_id", "text_key", F.col("longer").alias("rank")
    )


def repeated_runs(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50
) -> tuple[DataFrame, DataFrame]:
    """The active lines, and ``start, length, first`` of every later copy of a repeated run."""
    active = materialize(_active_lines(documents, id_col, text_col), "active-lines")
    runs = materialize(_shortest_runs(active, min_words), "runs")
    longest = runs.agg(F.max("length")).first()[0] or 0
    ranks = active.select("pos", "segment", "doc_id", "text_key", "rank")
    every = ranks.select(F.lit(1).alias("size"), "pos", "rank")
    size = 1
    while 2 * size <= longest:
        ranks = materialize(_doubled(ranks, size), "run-ranks")
        size *= 2
        every = every.unionByName(ranks.select(F.lit(size).alias("size"), "pos", "rank"))
    power = F.pow(F.lit(2), F.floor(F.log2("length"))).cast("int")
    ends = runs.withColumn("size", power).withColumn("tail", F.expr("start + length - size"))
    heads = every.select("size", F.col("pos").alias("start"), F.col("rank").alias("head_rank"))
    tails = every.select("size", F.col("pos").alias("tail"), F.col("rank").alias("tail_rank"))
    named = materialize(
        ends.join(heads, ["size", "start"])
        .join(tails, ["size", "tail"])
        .select("start", "length", "head_rank", "tail_rank"),
        "named-runs",
    )
    interval = ["length", "head_rank", "tail_rank"]
    firsts = named.groupBy(*interval).agg(F.min("start").alias("first"), F.count("*").alias("n"))
    # Stored, so that the join has a shuffle of its own and can split a run that is everywhere.
    firsts = materialize(firsts.where("n > 1"), "first-runs")
    later = (
        named.join(firsts, interval)
        .where("start > first")
        .select("start", "length", "first")
    )
    return active, later


def deduplicated_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50
) -> DataFrame:
    """``row`` (all columns of the document), ``kept_text``, ``n_lines``, ``n_removed``.

    Of every run of lines with ``min_words`` words or more that occurs again, in the same
    document or a later one (by id), the later copies are deleted. Lines are compared without
    the white space around them; blank lines do not interrupt a run and are never deleted. A
    run that overlaps its own copy, like one line over and over, is deleted but for its start.

    * A null text stays null with 0 lines; an empty text has no line to delete.
    * Documents of null id come last. Rows alike in id and text are one document, and each of
      them gets the same result; rows alike in id alone are ordered by a hash of their text.
    * An empty table gives no rows; other columns ride along untouched.
    """
    active, later = repeated_runs(documents, id_col, text_col, min_words)
    covered = later.select(F.explode(F.expr("sequence(start, start + length - 1)")).alias("pos"))
    gone = materialize(
        active.join(covered.distinct(), "pos", "left_semi")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list("line").alias("gone")),
        "deleted-lines",
    ).withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
    rows = documents.select(
        F.struct(*[column(name) for name in documents.columns]).alias("row"),
        *_document_key(id_col, text_col),
        column(text_col).alias("text"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
    # The list grows with the corpus: one plan for all sizes, which shuffles the texts once. A
    # text is split once; as an expression the split would be repeated for every line that stays.
    joined = rows.join(gone.hint("merge"), same, "left").select(
        "row", "text", "gone", once(F.split("text", "\n")).alias("lines")
    )
    staying = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.array_join(F.transform(staying, lambda at: F.get("lines", at)), "\n")
    return joined.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def drop_repeated_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50
) -> DataFrame:
    """``documents`` with the later copies of repeated runs of lines deleted; same columns."""
    result = deduplicated_lines(documents, id_col, text_col, min_words)
    return result.select(
        *[
            (F.col("kept_text") if name == text_col else F.col("row")[name]).alias(name)
            for name in documents.columns
        ]
    )
