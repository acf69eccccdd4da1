"""HTML extraction by nearest-URL page differencing.

Pages of a host are ordered by URL path; each is aligned line by line, by a longest common
subsequence, with the nearest one of another body, and what the two share is template, not
content. Copies, and pages that share most of their prose, are one body: what they share
says nothing. That decides on pages that mark no article. Where a page has an article element, its
lines stay, since a host may hold copies of one, and the differencing only takes shared lines
that are nothing but links; lines in menus, adverts and the like go everywhere.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom.llm.frames import column
from transitloom.llm.html_blocks import blocks
from transitloom.operators.ordering import with_rank
from transitloom.operators.skew import hot_keys, skew_join
from transitloom.storage import materialize

_URL = re.compile(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", re.IGNORECASE)
_PATH_END = re.compile(r"(?:/index)?(?:\.(?:html?|php|aspx?|jsp))?/*$", re.IGNORECASE)
_TABLE_BITS = 1 << 28
_SAME_SHARE, _FEW_WORDS = 0.8, 4
_BLOCK = 4096  # ranks in which runs of one body are looked up together


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host in lower case and the path without its conventional end; empty if there is none."""
    match = _URL.match((url or "").strip())
    if not match:
        return "", ""
    return match[1].rpartition("@")[2].lower(), _PATH_END.sub("", match[2])


def _rows_of_lengths(a: list[int], b: list[int]) -> list[int]:
    """For every prefix of ``a`` a number whose zero bits are where the length of its longest
    common subsequence with the prefixes of ``b`` grows."""
    places: dict[int, int] = {}
    for j, value in enumerate(b):
        places[value] = places.get(value, 0) | 1 << j
    every = (1 << len(b)) - 1
    row, rows = every, []
    for value in a:
        hit = row & places.get(value, 0)
        row = (row + hit | row - hit) & every
        rows.append(row)
    return rows


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with every prefix of ``b``."""
    row = _rows_of_lengths(a, b)[-1] if a else (1 << len(b)) - 1
    bits = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8)
    grows = 1 - np.unpackbits(bits, bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate([[0], np.cumsum(grows)])


def common_subsequence(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places ``(i, j)`` of a longest common subsequence of two sequences.

    Common ends are taken off first. What is left goes row by row with one bit per element of
    ``b``; where the rows together would be large, ``a`` is halved and ``b`` split where the
    halves fit best, so memory stays bounded for sequences of any length.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = [(k, k) for k in range(head)]
    inner_a, inner_b = a[head : len(a) - tail], b[head : len(b) - tail]
    if len(inner_a) * len(inner_b) > _TABLE_BITS and len(inner_a) > 1:
        half = len(inner_a) // 2
        fits = _lengths(inner_a[:half], inner_b) + _lengths(inner_a[half:][::-1], inner_b[::-1])[::-1]
        cut = int(fits.argmax())
        parts = [(0, half, 0, cut), (half, len(inner_a), cut, len(inner_b))]
        for i0, i1, j0, j1 in parts:
            inner = common_subsequence(inner_a[i0:i1], inner_b[j0:j1])
            found += [(head + i0 + i, head + j0 + j) for i, j in inner]
    elif inner_a and inner_b:
        rows = _rows_of_lengths(inner_a, inner_b)
        i, j, back = len(inner_a) - 1, len(inner_b) - 1, []
        while i >= 0 and j >= 0:
            if rows[i] >> j & 1:  # the last of b's prefix adds nothing
                j -= 1
            elif i and not rows[i - 1] >> j & 1:  # nor does the last of a's
                i -= 1
            else:
                back.append((head + i, head + j))
                i, j = i - 1, j - 1
        found += back[::-1]
    return found + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


def _lines_key(codes: np.ndarray) -> tuple[int, int]:
    """128 bits of a page's lines in order."""
    data = codes.tobytes()
    return xxhash.xxh64_intdigest(data) - (1 << 63), xxhash.xxh64_intdigest(data, 1) - (1 << 63)


def _codes(lines: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(line) - (1 << 63) for line in lines], dtype=np.int64)


def _bodies(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``host, lines_a, lines_b, path, codes, prose``: one row for all pages of a host with the
    same lines, at the first of their paths; lines as hashes, with how much prose they are."""
    rows = pages.select(column(url_col).alias("url"), column(html_col).alias("html"))

    def read(batches):
        for batch in batches:
            places = [host_and_path(url) for url in batch.column("url").to_pylist()]
            lines = [[block.text for block in blocks(page or "")] for page in batch.column("html").to_pylist()]
            codes = [_codes(own) for own in lines]
            keys = [_lines_key(own) for own in codes]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([host for host, _ in places], pa.string()),
                    pa.array([key for key, _ in keys], pa.int64()),
                    pa.array([key for _, key in keys], pa.int64()),
                    pa.array([path for _, path in places], pa.string()),
                    pa.array([own.tolist() for own in codes], pa.list_(pa.int64())),
                    pa.array([[prose(line) for line in own] for own in lines], pa.list_(pa.int32())),
                ],
                names=["host", "lines_a", "lines_b", "path", "codes", "prose"],
            )

    schema = "host string, lines_a bigint, lines_b bigint, path string, codes array<bigint>, prose array<int>"
    found = rows.mapInArrow(read, schema).where("host <> '' AND size(codes) > 0")
    return found.groupBy("host", "lines_a", "lines_b").agg(
        F.min("path").alias("path"), F.first("codes").alias("codes"), F.first("prose").alias("prose")
    )


def prose(line: str) -> int:
    """Words of a line beyond the few that names of links, headings and dates have."""
    return max(0, line.count(" ") + 1 - _FEW_WORDS)


def same_body(a: list[int], b: list[int], prose_a: list[int], prose_b: list[int]) -> bool:
    """Whether two pages are one body: the lines they share hold ``_SAME_SHARE`` or more of the
    prose of the page that has less. Pages without prose are bodies of their own."""
    least = min(sum(prose_a), sum(prose_b))
    shared = sum(prose_a[i] for i, _ in common_subsequence(a, b))
    return least > 0 and shared >= _SAME_SHARE * least


def _near(path: str, other: str) -> int:
    """Length of the common start of two paths."""
    return next((k for k, (x, y) in enumerate(zip(path, other)) if x != y), min(len(path), len(other)))  # noqa: B905


def _partners(ranked: DataFrame) -> DataFrame:
    """``rank, partner``: for every page the last one before, and the first one after, the run of
    neighbours of the same body that it stands in.

    A run begins where a page differs from the one before it. Where the run of a page begins and
    ends is looked up inside blocks of ranks, and between blocks by two numbers each, so that
    neither a host nor a run of any length is one task's work.
    """
    following = ranked.select(
        (F.col("rank") - 1).alias("rank"), *[F.col(x).alias(f"next_{x}") for x in ("host", "codes", "prose")]
    )
    pairs = ranked.join(following, "rank").where("host = next_host")

    def compare(batches):
        for batch in batches:
            same = [
                same_body(row["codes"], row["next_codes"], row["prose"], row["next_prose"])
                for row in batch.to_pylist()
            ]
            ranks = pa.compute.add(batch.column("rank"), 1)
            yield pa.RecordBatch.from_arrays([ranks, pa.array(same, pa.bool_())], names=["rank", "same"])

    # Of each page but the first of its host: whether it is the body of the one before.
    compared = pairs.select("rank", "codes", "next_codes", "prose", "next_prose")
    compared = compared.mapInArrow(compare, "rank bigint, same boolean")
    rows = ranked.select("rank").join(compared, "rank", "left").select(
        "rank", F.floor(F.col("rank") / _BLOCK).alias("block"),
        F.when(~F.coalesce("same", F.lit(False)), F.col("rank")).alias("begin"),
    )
    rows = materialize(rows, "runs")
    blocks_ = rows.groupBy("block").agg(F.max("begin").alias("latest"), F.min("begin").alias("earliest"))
    order = Window.partitionBy(F.lit(0)).orderBy("block")
    carried = blocks_.select(
        "block",
        F.max("latest").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.min("earliest").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    inside = Window.partitionBy("block").orderBy("rank")
    begin = F.max("begin").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.min("begin").over(inside.rowsBetween(1, Window.unboundedFollowing))
    ends = rows.withColumns({"_begin": begin, "_ahead": ahead}).join(carried, "block").select(
        "rank", F.coalesce("_begin", "_before").alias("begin"), F.coalesce("_ahead", "_after").alias("ahead")
    )
    return ends.select("rank", F.explode(F.array_compact(F.array(F.col("begin") - 1, "ahead"))).alias("partner"))


def shared_lines(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, lines_a, lines_b, shared``: places of the lines that pages share with their nearest
    page of another body.

    Pages of a host with the same lines are one; the others are ranked by path over all tasks.
    Neighbours that share most of their prose, like copies with another date, are one body. Each
    page is aligned with the nearer of the pages before and after its body's run: the one with
    the longer common start of the path, the one before where both are as near. A page that is
    wholly shared tells nothing about itself, and a host with one body nothing about its pages.
    """
    ranked = with_rank(_bodies(pages, url_col, html_col), ["host", "path", "lines_a", "lines_b"], "rank")
    ranked = materialize(ranked, "ranked-pages")
    options = materialize(_partners(ranked), "partners")
    names = ["host", "path", "codes"]
    own = options.join(ranked.select("rank", "lines_a", "lines_b", *names), "rank")
    theirs = ranked.select(F.col("rank").alias("partner"), *[F.col(x).alias(f"other_{x}") for x in names])
    # A page beside a long run is the partner of all of it.
    met = skew_join(own, theirs, ["partner"], "inner", unique_right=True, left_hot=hot_keys(options, ["partner"]))
    before = (F.col("partner") < F.col("rank")).cast("int").alias("before")
    met = met.where("host = other_host").select(
        "host", "lines_a", "lines_b", "path", "codes", "other_path", "other_codes", before
    )

    def align(batches):
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                a, b = row["codes"], row["other_codes"]
                matched = [i for i, _ in common_subsequence(a, b)]
                near = 2 * _near(row["path"], row["other_path"]) + row["before"]
                shared = matched if len(matched) < len(a) else []
                found.append((row["host"], row["lines_a"], row["lines_b"], near, shared))
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["host", "lines_a", "lines_b", "near", "shared"],
            )

    aligned = met.mapInArrow(
        align, "host string, lines_a bigint, lines_b bigint, near bigint, shared array<int>"
    )
    return aligned.groupBy("host", "lines_a", "lines_b").agg(F.max_by("shared", "near").alias("shared"))


def candidates(lines: list[str], marks: bytes) -> tuple[list[str], list[int]]:
    """The lines that are main text unless shared, and of each its place, or -1 where it stays
    shared or not.

    Furniture goes. If the page marks no article, lines stay that are not shared. Where it does,
    the lines inside the innermost kind of marked element stay, shared or not, but for shared
    lines that are nothing but links.
    """
    plain = [mark for mark in marks if not mark >> 2 & 1]
    rank = max((mark & 3 for mark in plain), default=0)
    kept, places = [], []
    for k, (line, mark) in enumerate(zip(lines, marks, strict=True)):
        furniture, linked = mark >> 2 & 1, mark >> 3 & 1
        if furniture or mark & 3 != rank:
            continue
        kept.append(line)
        places.append(k if rank == 0 or linked else -1)
    return kept, places


def main_text(lines: list[str], places: list[int], shared: set[int]) -> str:
    """The candidate lines of a page whose place is not shared, one per line of the result."""
    return "\n".join(line for line, place in zip(lines, places, strict=True) if place not in shared)


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: ``page_id, url, text``.

    * A null or empty page has an empty text, and so has one without any.
    * Pages without a host (null, relative or odd URLs) have no neighbours: only their
      elements tell what is main text.
    * Pages of a host with the same lines are one among the neighbours, and each gets its text.
    * Extra columns are ignored; an empty table gives no rows.
    """
    shared = materialize(shared_lines(pages, url_col, html_col), "shared-lines")
    own = pages.select(
        column(id_col).alias("page_id"), column(url_col).alias("url"), column(html_col).alias("html")
    )

    def pack(batches):
        # Only the lines that may be main text travel to their shared lines, compressed.
        for batch in batches:
            packed, places, keys = [], [], []
            for source in batch.column("html").to_pylist():
                found = blocks(source or "")
                lines = [block.text for block in found]
                marks = bytes(b.rank | b.furniture << 2 | b.linked << 3 for b in found)
                kept, at = candidates(lines, marks)
                packed.append(zlib.compress("\n".join(kept).encode(), 6))
                places.append(at)
                keys.append(_lines_key(_codes(lines)))
            hosts = [host_and_path(url)[0] for url in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("page_id", "url")),
                    pa.array(hosts, pa.string()),
                    *(pa.array([key[k] for key in keys], pa.int64()) for k in (0, 1)),
                    pa.array(packed, pa.binary()),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                names=["page_id", "url", "host", "lines_a", "lines_b", "packed", "places"],
            )

    def choose(batches):
        for batch in batches:
            texts = []
            for packed, places, found in zip(
                *(batch.column(name).to_pylist() for name in ("packed", "places", "shared")), strict=True
            ):
                lines = zlib.decompress(packed).decode().split("\n") if places else []
                texts.append(main_text(lines, places, set(found or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    ids = [own.schema["page_id"], own.schema["url"]]
    packed_fields = T.StructType.fromDDL(
        "host string, lines_a bigint, lines_b bigint, packed binary, places array<int>"
    )
    packed = own.mapInArrow(pack, T.StructType([*ids, *packed_fields.fields]))
    # The shared lines grow with the pages: one plan for all sizes, which shuffles the texts once.
    joined = packed.join(shared.hint("merge"), ["host", "lines_a", "lines_b"], "left")
    joined = joined.drop("host", "lines_a", "lines_b")
    return joined.mapInArrow(choose, T.StructType([*ids, T.StructField("text", T.StringType())]))
