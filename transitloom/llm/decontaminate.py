"""Benchmark decontamination by a broadcast set of normalised n-grams."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom.llm.frames import ascii_lower, batch_texts, column, packed_text, unpacked
from transitloom.storage import materialize

# Words are runs of a-z, 0-9 and characters beyond ASCII; as bytes, these are the classes.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_WORD_CHARS = "([^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+)"
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_WORDS_AT_ONCE = 250_000
_BYTES_AT_ONCE = 1 << 20
_SPANS = "array<struct<start:bigint,end:bigint>>"
_FOUND = f"spans {_SPANS}, items array<string>, n_words bigint"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def benchmark_windows(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = 13
) -> DataFrame:
    """Distinct ``(window, item)``: every run of ``n`` words of an item, as space-joined text.

    An item of fewer words, but not none, is one window. A null or wordless text has none;
    a null id is called ``null``.
    """
    words = F.regexp_extract_all(ascii_lower(column(text_col)), F.lit(_WORD_CHARS), 1)
    return (
        benchmark.select(
            F.coalesce(column(id_col).cast("string"), F.lit("null")).alias("item"),
            words.alias("words"),
        )
        .where(F.size("words") > 0)
        .select(
            "item",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.size("words") - (n - 1), F.lit(1))),
                    lambda i: F.array_join(F.slice("words", i, n), " "),
                )
            ).alias("window"),
        )
        .distinct()
    )


class _WindowSet:
    """The windows of one broadcast block, ready for scanning word arrays."""

    def __init__(self, pairs: list[tuple[str, str]]):
        items: dict[tuple[bytes, ...], set[str]] = {}
        for window, item in pairs:
            items.setdefault(tuple(window.encode().split(b" ")), set()).add(item)
        self.word_ids: dict[bytes, int] = {}
        for words in items:
            for word in words:
                self.word_ids.setdefault(word, len(self.word_ids) + 1)
        self.longest = max(map(len, items), default=0)
        rng = np.random.default_rng(7)
        self.factors = rng.integers(1, 2**63, self.longest, dtype=np.uint64) | np.uint64(1)
        tables: dict[int, dict[int, list]] = {}
        for words, found in items.items():
            ids = np.array([self.word_ids[word] for word in words], dtype=np.uint64)
            code = int((ids * self.factors[: len(ids)]).sum(dtype=np.uint64))
            tables.setdefault(len(ids), {}).setdefault(code, []).append((ids, found))
        self.by_length = {
            length: (np.sort(np.array(list(table), dtype=np.uint64)), table)
            for length, table in tables.items()
        }

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """``(place, length, items)`` of every verified window in an array of word ids."""
        code = np.zeros(len(ids), dtype=np.uint64)
        for length in range(1, min(self.longest, len(ids)) + 1):
            places = len(ids) - length + 1
            code = code[:places] + ids[length - 1 :] * self.factors[length - 1]
            if length not in self.by_length:
                continue
            codes, table = self.by_length[length]
            near = np.searchsorted(codes, code)
            near[near == len(codes)] = 0
            for place in np.flatnonzero(codes[near] == code):
                for window, items in table[int(code[place])]:
                    if np.array_equal(window, ids[place : place + length]):
                        yield int(place), length, items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, in order."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], end))
        else:
            merged.append((start, end))
    return merged


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded number at a time."""
    text, at = text.lower(), 0
    while at < len(text):
        gap = _GAP.search(text, at + _BYTES_AT_ONCE)
        end = gap.start() if gap else len(text)
        yield _WORD.findall(text, at, end)
        at = end


def _scan(windows: _WindowSet, texts: list[bytes | None]):
    """Per text: number of words, merged word spans of window occurrences, items found."""
    counts = [0] * len(texts)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]

    def search(arrays: list[np.ndarray], places: list[int]) -> None:
        ids = np.concatenate(arrays)
        begins = np.cumsum([0] + [len(array) for array in arrays])
        for at, length, found in windows.occurrences(ids):
            k = int(np.searchsorted(begins, at, "right")) - 1
            first = int(at - begins[k])
            spans[places[k]].append((first, first + length))
            items[places[k]] |= found

    arrays, places, gathered = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        # Unknown words are 0, and one more 0 keeps windows from reaching into the next text.
        parts = [
            np.fromiter(map(windows.word_ids.get, words, itertools.repeat(0)), np.uint64, len(words))
            for words in _words(text)
        ]
        ids = np.concatenate([*parts, np.zeros(1, dtype=np.uint64)])
        counts[i] = len(ids) - 1
        arrays.append(ids)
        places.append(i)
        gathered += len(ids)
        if gathered >= _WORDS_AT_ONCE:
            search(arrays, places)
            arrays, places, gathered = [], [], 0
    if arrays:
        search(arrays, places)
    return counts, [_merged(found) for found in spans], items


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 13,
    max_pairs: int = 250_000,
    max_bytes: int = 64 << 20,
    carry: list[str] | None = None,
) -> DataFrame:
    """``row`` (the document's columns, or those in ``carry``), ``n_words``, ``spans``, ``items``.

    ``spans`` are the word ranges ``[start, end)`` covered by occurrences of benchmark
    windows, merged; ``items`` the distinct items with an occurring window, as strings.
    The set of windows is broadcast in blocks of about ``max_pairs`` pairs of window and item
    and ``max_bytes`` of their texts at most, both added up beforehand (words may be of any
    length); a larger benchmark takes several passes, and nothing is left out. Every window found by its code is compared word by word.

    * A null or wordless text has no words, no spans and no items.
    * An empty benchmark finds nothing; an empty table gives no rows.
    * Repeated rows are judged each on its own; other columns ride along untouched.
    """
    spark = documents.sparkSession
    pairs = materialize(
        benchmark_windows(benchmark, item_col, item_text_col, n), "benchmark-windows"
    )
    held = F.octet_length("window") + F.octet_length("item")
    total = pairs.agg(F.count("*").alias("pairs"), F.sum(held).alias("bytes")).first()
    blocks = max(1, ceil(total["pairs"] / max_pairs), ceil((total["bytes"] or 0) / max_bytes))
    block = F.pmod(F.xxhash64("window", "item"), F.lit(blocks))
    state = packed_text(
        documents,
        text_col,
        carry,
        spans=F.array().cast(_SPANS),
        items=F.array().cast("array<string>"),
    )
    own = [field for field in state.schema if field.name in ("row", "text")]
    schema = T.StructType([*own, *T.StructType.fromDDL(_FOUND).fields])
    for number in range(blocks):
        mine = pairs.where(block == number).select("window", "item").collect()
        windows = spark.sparkContext.broadcast([tuple(pair) for pair in mine])

        def scan(batches, windows=windows):
            index = _WindowSet(windows.value)
            for batch in batches:
                counts, spans, items = _scan(index, batch_texts(batch, text_col))
                for i, known in enumerate(batch.column("spans").to_pylist()):
                    spans[i] = _merged([*spans[i], *((s["start"], s["end"]) for s in known)])
                for i, known in enumerate(batch.column("items").to_pylist()):
                    items[i].update(known)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(field.name) for field in own),
                        pa.array(
                            [[{"start": a, "end": b} for a, b in found] for found in spans],
                            _ARROW_SPANS,
                        ),
                        pa.array([sorted(found) for found in items], pa.list_(pa.string())),
                        pa.array(counts, pa.int64()),
                    ],
                    names=schema.names,
                )

        state = state.drop("n_words").mapInArrow(scan, schema)
        if number + 1 < blocks:
            state = materialize(state, "scanned")
    return state.select("row", "n_words", "spans", "items")


def hit_words(spans: Column) -> Column:
    """Number of words in merged spans."""
    return F.aggregate(
        F.transform(spans, lambda s: s["end"] - s["start"]),
        F.lit(0).cast("bigint"),
        lambda total, size: total + size,
    )


def is_contaminated(n_words: Column, n_hit: Column, one_in: int = 20) -> Column:
    """Whether words are hit, and at least one in ``one_in`` of all."""
    return (n_hit > 0) & (one_in * n_hit >= n_words)


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, one_in: int = 20, **options
) -> DataFrame:
    """``documents`` without the rows that are contaminated; same columns.

    ``options`` go to :func:`contamination`, whose cases hold here too.
    """
    found = contamination(documents, benchmark, **options)
    dirty = is_contaminated(F.col("n_words"), hit_words(F.col("spans")), one_in)
    return unpacked(found.where(~dirty), documents)


def cut_spans(
    documents: DataFrame, benchmark: DataFrame, text_col: str = "text", **options
) -> DataFrame:
    """``documents`` with the words of benchmark windows cut out of the text; same columns.

    Each span goes from the first byte of its first to the last byte of its last word; what
    stands between other words stays. Null and clean texts are unchanged.
    """
    found = contamination(documents, benchmark, text_col=text_col, **options)

    def cut(batches):
        for batch in batches:
            texts = []
            spans = batch.column("spans").to_pylist()
            for text, ranges in zip(batch_texts(batch, text_col), spans, strict=True):
                if text is not None and ranges:
                    words = [match.span() for match in _WORD.finditer(text.lower())]
                    for place in reversed(ranges):
                        text = text[: words[place["start"]][0]] + text[words[place["end"] - 1][1] :]
                texts.append(None if text is None else text.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string())], names=["row", "clean"]
            )

    schema = T.StructType([found.schema["row"], T.StructField("clean", T.StringType())])
    cleaned = found.select("row", "spans").mapInArrow(cut, schema)
    return cleaned.select(
        *[
            (F.col("clean") if name == text_col else F.col("row")[name]).alias(name)
            for name in documents.columns
        ]
    )
