"""SimHash near-duplicates by covering locality-sensitive hashing.

Every one of the 64 bit positions carries a vector of ``radius + 1`` bits, not zero. For each
of the ``2 ** (radius + 1) - 1`` vectors v that are not zero, one table keeps the positions
whose vector has an odd product with v. At most ``radius`` differing positions cannot span
the whole space, so some v is orthogonal to all of them: in that table the two fingerprints
agree, and the pair is found for certain. With radius 4 these are 31 tables of about 33 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.llm.frames import column
from transitloom.operators.traversal import connected_components
from transitloom.storage import materialize

_SEED = 42
_SHINGLES_AT_ONCE = 1 << 16


def simhash(text: bytes | None, shingle: int = 4) -> int:
    """64-bit fingerprint: the majority of each bit over the hashes of all word shingles."""
    words = text.lower().split() if text else []  # ASCII case and white space, as bytes
    if not words:
        return 0
    run = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    count = max(1, len(words) - shingle + 1)
    starts = (ends - sizes)[:count].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    code = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, _SHINGLES_AT_ONCE):
        part = slice(at, at + _SHINGLES_AT_ONCE)
        hashes = np.fromiter(
            (code(run[a:b], _SEED) for a, b in zip(starts[part], stops[part], strict=True)),
            np.uint64,
            min(count - at, _SHINGLES_AT_ONCE),
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * ones > count, bitorder="little")
    return int(chosen.view(np.uint64)[0])


def fingerprints(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4
) -> DataFrame:
    """``doc_id, text_key, fp``: one row per row; ``text_key`` is a 64-bit hash of the text.

    Words are runs of other than ASCII white space, A-Z in lower case; a text of fewer words
    than ``shingle`` is one shingle; a null or wordless text has fingerprint 0.
    """
    rows = documents.select(
        column(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(column(text_col)).alias("text_key"),
        column(text_col).cast("binary").alias("text"),
    )

    def compute(batches):
        for batch in batches:
            marks = [simhash(text, shingle) for text in batch.column("text").to_pylist()]
            signed = np.array(marks, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(signed, pa.int64())],
                names=["doc_id", "text_key", "fp"],
            )

    return rows.mapInArrow(compute, "doc_id bigint, text_key bigint, fp bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """The bits kept by each table, for fingerprints that differ only at ``positions``."""
    vectors = (1 << (radius + 1)) - 1
    carried = {bit: 1 + k % vectors for k, bit in enumerate(positions)}
    return [
        sum(1 << bit for bit, own in carried.items() if (own & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def tree_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what lies within ``radius`` bits among distinct 64-bit values.

    At most one link less than there are values: each value is compared with those not yet
    reached, and leaves them once it is reached itself.
    """
    links = []
    rest = values
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            own = queue.pop()
            near = np.bitwise_count(rest ^ own) <= radius
            if near.any():
                found = rest[near]
                links.extend((int(own), int(other)) for other in found)
                queue.extend(found)
                rest = rest[~near]
    return links


def links_within(values: DataFrame, radius: int = 4, bucket_rows: int = 16_384) -> DataFrame:
    """``src, dst``: links between distinct fingerprints ``fp`` at ``radius`` bits or fewer.

    Together they connect everything that such pairs connect; a pair that adds nothing to
    that need not be among them. A bucket of two is one comparison; up to ``bucket_rows``
    fingerprints are compared in one task, which returns a spanning forest. The fingerprints
    of a larger bucket agree on the bits its table keeps, so they are dealt again by covering
    masks over its other bits: what agrees there as well has, with radius 4, at most
    ``2 ** 16`` different fingerprints, however large the input.
    """
    masks = covering_masks(list(range(64)), radius)
    every = F.array(*[F.lit(_signed(mask)) for mask in masks])
    tall = values.select("fp", F.posexplode(every).alias("slot", "mask")).select(
        "fp", "slot", F.col("fp").bitwiseAND(F.col("mask")).alias("kept")
    )
    links, sizes = _bucket_links(tall, ["slot", "kept"], radius, bucket_rows)
    large = sizes.where(F.col("n") > bucket_rows).select("slot", "kept")
    if not large.isEmpty():
        free = [[bit for bit in range(64) if not mask >> bit & 1] for mask in masks]
        inner = F.array(
            *[
                F.array(*[F.lit(_signed(mask)) for mask in covering_masks(bits, radius)])
                for bits in free
            ]
        )
        dealt = (
            tall.join(large, ["slot", "kept"])
            .select("fp", "slot", "kept", F.posexplode(inner[F.col("slot")]).alias("part", "mask"))
            .withColumn("agreed", F.col("fp").bitwiseAND(F.col("mask")))
            .drop("mask")
        )
        more, _ = _bucket_links(dealt, ["slot", "kept", "part", "agreed"], radius, None)
        links = links.unionByName(more)
    return links.distinct()


def _bucket_links(tall: DataFrame, at: list[str], radius: int, most: int | None):
    """Links inside the buckets of ``at`` (of up to ``most`` rows), and the buckets' sizes."""
    sizes = materialize(
        tall.groupBy(*at)
        .agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
        .where("n > 1"),
        "covering-buckets",
    )
    near = F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= radius
    pairs = sizes.where((F.col("n") == 2) & near).select(
        F.col("low").alias("src"), F.col("high").alias("dst")
    )
    crowded = sizes.where(F.col("n") > 2 if most is None else F.col("n").between(3, most))
    gathered = tall.join(crowded.select(*at), at).groupBy(*at).agg(F.collect_list("fp").alias("fps"))

    def compare(batches):
        for batch in batches:
            found = []
            for values in batch.column("fps"):
                members = np.sort(values.values.to_numpy().view(np.uint64))
                found += tree_links(members, radius)
            ends = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["src", "dst"]
            )

    compared = gathered.select("fps").mapInArrow(compare, "src bigint, dst bigint")
    return pairs.unionByName(compared), sizes


def _grouped(documents, id_col, text_col, shingle, radius) -> DataFrame:
    """``doc_id, text_key, fp, component, component_id``; ``component`` names the group."""
    marks = materialize(fingerprints(documents, id_col, text_col, shingle), "fingerprints")
    values = materialize(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-marks")
    links = materialize(links_within(values, radius), "near-links")
    found = connected_components(links).withColumnRenamed("id", "fp")
    named = materialize(
        values.join(found, "fp", "left").select(
            "fp", "first", F.coalesce("component", "fp").alias("component")
        ),
        "marks-in-groups",
    )
    firsts = named.groupBy("component").agg(F.min("first").alias("component_id"))
    group_of = materialize(named.drop("first").join(firsts, "component"), "groups-of-marks")
    return marks.join(group_of, "fp")


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
) -> DataFrame:
    """One row per row: ``doc_id, fingerprint, component_id``.

    Fingerprints at ``radius`` differing bits or fewer are linked, and ``component_id`` is
    the smallest id reached over links, the own one included. Equal fingerprints are brought
    together first, so a group of copies is one value, whatever its size.

    * Null and wordless texts have fingerprint 0 and are linked like any other.
    * A null id is never the smallest; a group of null ids alone has a null ``component_id``.
    * Repeated rows appear as often as they occur; extra columns are ignored.
    * An empty table gives no rows.
    """
    return _grouped(documents, id_col, text_col, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
) -> DataFrame:
    """``documents`` with one row of each group of near-duplicates; same columns.

    The row of the smallest id stays (of several with that id, the one whose text has the
    smallest hash; of repeated rows, one). Groups of null ids alone keep one row too.
    """
    key = ["doc_id", "text_key"]
    marked = materialize(_grouped(documents, id_col, text_col, shingle, radius), "near-groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    best = marked.groupBy("component").agg(F.min(order).alias("best"))
    staying = best.select("best.doc_id", "best.text_key")
    counted = materialize(marked.groupBy(*key).count(), "row-keys")
    gone = materialize(_matching(counted, staying, key, "left_anti").select(*key), "dropped-rows")
    repeated = materialize(
        _matching(counted.where("count > 1"), staying, key, "left_semi").select(*key), "repeated"
    )

    own = [
        column(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(column(text_col)).alias("text_key"),
    ]
    rows = documents.select(
        *own, F.struct(*[column(name) for name in documents.columns]).alias("row")
    )
    # The list grows with the corpus: one plan for all sizes, which shuffles the texts once.
    kept = _matching(rows, gone.hint("merge"), key, "left_anti")
    if not repeated.isEmpty():
        once = _matching(kept, repeated, key, "left_semi").dropDuplicates(key)
        kept = _matching(kept, repeated, key, "left_anti").unionByName(once)
    return kept.select(*[F.col("row")[name].alias(name) for name in documents.columns])


def _matching(left: DataFrame, right: DataFrame, key: list[str], how: str) -> DataFrame:
    """Join where null keys match each other."""
    other = right.withColumnsRenamed({name: f"_{name}" for name in key})
    same: Column = F.lit(True)
    for name in key:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return left.join(other, same, how)
