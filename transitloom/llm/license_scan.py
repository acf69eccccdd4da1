"""License scans by canonical digest: texts are normalised whole, hashed, and looked up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.llm.frames import column
from transitloom.llm.license_texts import KNOWN_TEXTS
from transitloom.operators.skew import BROADCAST_ROWS, skew_join
from transitloom.storage import materialize

# Patterns and what replaces them, in this order, on text in lower case.
# Copyright lines go, runs of punctuation and blanks become one space (line ends stay), and
# equivalent spellings get one form. They mean the same in any common regular-expression
# dialect, so that the check in SQL can use them too.
REWRITES = (
    (
        r"(^|\n)[ \t]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]|<|\[)|\(c\)[ \t]*[0-9]|©"
        r"|all rights reserved)[^\n]*",
        "$1",
    ),
    (r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F©“”‘’«»–—…•]+", " "),
    (r"(^|[ \n])(sub ?)?licenc", "$1$2licens"),
    (r"(^|[ \n])(sub|non) (licens|commercial)", "$1$2$3"),
    (r"(^|[ \n])(fav|col|hon|behavi|lab)our", "$1$2or"),
    (r"(^|[ \n])(author|recogn|organ|util|summar|minim|maxim)is(e|ing|ation)", "$1$2iz$3"),
)
# Further spellings that are replaced as they stand.
SPELLINGS = (
    ("copyright owner", "copyright holder"),
    ("acknowledgement", "acknowledgment"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("per cent", "percent"),
)


def canonical_lines(text: Column) -> Column:
    """The normalised lines of a text that are not empty."""
    plain = F.lower(text)
    for pattern, replacement in REWRITES:
        plain = F.regexp_replace(plain, pattern, replacement)
    for spelling, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(spelling), F.lit(usual))
    lines = F.transform(F.split(plain, "\n"), lambda line: F.btrim(line, F.lit(" ")))
    return F.filter(lines, lambda line: line != "")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _digests(lines: Column) -> tuple[Column, Column]:
    """The digest of the whole text and those of its lines."""
    return _digest(F.array_join(lines, " ")), F.transform(lines, _digest)


def known_licenses(spark: SparkSession) -> DataFrame:
    """``license_id, text`` of the texts that come with the library."""
    return spark.createDataFrame(list(KNOWN_TEXTS), "license_id string, text string")


def scan_licenses(
    documents: DataFrame,
    known: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known_id_col: str = "license_id",
    known_text_col: str = "text",
) -> DataFrame:
    """One row per row: ``doc_id, text_digest, license, notices, n_notice_lines``.

    Every document as a whole, and every line of it as a whole, is normalised, hashed to 128
    bits and joined with the digests of the known texts. ``license`` is the known text that
    the document is; ``notices`` are those that some of its lines are, sorted and
    comma-joined; ``n_notice_lines`` counts these lines. Of known texts that are the same
    after normalisation all ids are given, comma-joined.

    * A null text is nothing: no digest, no license. One without a word, or known text
      without one, matches nothing.
    * Repeated rows get the same result each; extra columns are ignored; an empty table of
      documents gives no rows, one of known texts no matches.
    """
    own = canonical_lines(column(known_text_col))
    table = (
        known.select(column(known_id_col).cast("string").alias("license_id"), own.alias("lines"))
        .where(F.size("lines") > 0)
        .select("license_id", _digest(F.array_join("lines", " ")).alias("digest"))
        .groupBy("digest")
        .agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("license_id"))
    )
    table = materialize(table, "known-digests")
    whole, lines = _digests(F.col("lines"))
    hashed = materialize(
        documents.select(
            column(id_col).alias("doc_id"),
            F.xxhash64(column(text_col)).alias("text_key"),
            canonical_lines(column(text_col)).alias("lines"),
        ).select(
            "doc_id", "text_key",
            whole.alias("digest"),
            lines.alias("line_digests"),
        ),
        "digests",
    )
    key = ["doc_id", "text_key"]
    whole_unit = F.struct("digest", F.lit(-1).alias("line"))
    line_units = F.transform(
        "line_digests", lambda digest, at: F.struct(digest.alias("digest"), at.alias("line"))
    )
    units = hashed.select(
        *key, F.explode(F.array_append(line_units, whole_unit)).alias("unit")
    ).select(*key, "unit.digest", "unit.line")
    is_line = F.col("line") >= 0
    # Rows alike in id and text are one document here.
    # The digests of known texts are few: where that holds, lines are looked up where they are,
    # and only those found are moved. More than that are joined with frequent lines salted.
    if table.count() <= BROADCAST_ROWS:
        found = units.join(F.broadcast(table), "digest")
    else:
        found = skew_join(units, table, ["digest"], unique_right=True)
    matches = (
        found.dropDuplicates([*key, "line"])
        .groupBy(*key)
        .agg(
            F.max(F.when(~is_line, F.col("license_id"))).alias("license"),
            F.array_sort(F.collect_set(F.when(is_line, F.col("license_id")))).alias("notices"),
            F.count(F.when(is_line, 1)).alias("n_notice_lines"),
        )
    )
    matches = materialize(matches, "license-matches")
    found = matches.withColumnsRenamed({name: f"_{name}" for name in key})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
    return hashed.select(*key, "digest").join(found, same, "left").select(
        "doc_id",
        F.lower(F.hex("digest")).alias("text_digest"),
        "license",
        F.coalesce(F.array_join("notices", ","), F.lit("")).alias("notices"),
        F.coalesce("n_notice_lines", F.lit(0)).cast("bigint").alias("n_notice_lines"),
    )
