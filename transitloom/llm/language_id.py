"""Language identification by prediction by partial matching over bytes.

One variable-order context tree per language is learnt once and then frozen. A text's
code length under a language is the sum, over its bytes, of the bits the tree spends:
the byte's own probability in the longest context that has seen it, plus an escape for
every longer context that is known but has not. The shortest code wins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom.llm.frames import batch_texts, column, content_key, packed_text, unpacked
from transitloom.storage import discard, materialize

UNDETERMINED = "und"
_BYTES_AT_ONCE = 1 << 19
_LANGUAGES_AT_ONCE = 8  # languages whose trees share their keys
_CELLS_AT_ONCE = 1 << 24  # languages times grams that one pass over the documents holds
# Bits a byte that letters of a language may cost. Measured with trees of the given corpus: prose
# on other topics 4.6 to 6.3, its own documents up to 7.1 (secrets among few words), random hex
# digits 7.8 to 8.5, random letters 12 to 14, other scripts 20.
_MOST_BITS = 7.5
_LETTERS = 1  # bytes of context that tell a language's letters, but nothing of what texts are about
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _grams(text: np.ndarray, breaks: np.ndarray, order: int) -> np.ndarray:
    """For every byte, the byte and the ``order`` before it as one number.

    ``breaks`` are the starts of the texts: in front of them stand zeros.
    """
    padded = np.insert(_LOWER[text], np.repeat(breaks, order), 0) if order else _LOWER[text]
    real = np.ones(len(padded), dtype=bool)
    for k in range(order):
        real[breaks + order * np.arange(len(breaks)) + k] = False
    wide = padded.astype(np.uint32)
    code = wide.copy()
    for back in range(1, order + 1):
        code[back:] |= wide[:-back] << np.uint32(8 * back)
    return code[real]


class _Lookup:
    """Exact places of 32-bit keys in a sorted array, by a direct table first."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(8, int(np.ceil(np.log2(len(keys) + 1))) + 3)
        slots = self._slot(keys)
        self.table = np.zeros(1 << self.bits, dtype=np.int32)
        self.table[slots] = np.arange(len(keys))
        self.shared = np.bincount(slots, minlength=1 << self.bits) > 1

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(2654435761)) >> np.uint32(32 - self.bits)

    def __call__(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each code, and whether it is among the keys."""
        if not len(self.keys):
            return np.zeros(len(codes), dtype=np.int32), np.zeros(len(codes), dtype=bool)
        slots = self._slot(codes)
        place = self.table[slots]
        known = self.keys[place] == codes
        unsure = np.flatnonzero(~known & self.shared[slots])
        if len(unsure):
            near = np.searchsorted(self.keys, codes[unsure])
            near[near == len(self.keys)] = 0
            place[unsure] = near
            known[unsure] = self.keys[near] == codes[unsure]
        return place, known


@dataclass
class ContextTrees:
    """Frozen statistics: per order, the known grams with their cost for every language."""

    languages: list[str]
    order: int
    grams: list[np.ndarray] = field(default_factory=list)  # by order: sorted keys
    bits: list[np.ndarray] = field(default_factory=list)  # by order: languages x keys
    contexts: list[np.ndarray] = field(default_factory=list)
    escapes: list[np.ndarray] = field(default_factory=list)  # by order: languages x contexts

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Learn the next order from its grams and their counts (languages x keys)."""
        order = len(self.grams)
        # The context is what the gram holds besides its last byte.
        contexts, of = np.unique(keys >> np.uint32(8), return_inverse=True)
        total = np.zeros((len(self.languages), len(contexts)))
        distinct = np.zeros_like(total)
        for k in range(len(self.languages)):
            total[k] = np.bincount(of, counts[k], len(contexts))
            distinct[k] = np.bincount(of, counts[k] > 0, len(contexts))
        known = total > 0
        escapes = np.zeros_like(total)
        escapes[known] = -np.log2(distinct[known] / (total + distinct)[known])
        with np.errstate(divide="ignore", invalid="ignore"):
            own = -np.log2(counts / (total + distinct)[:, of])
        lower = self.code_lengths(keys & np.uint32((1 << 8 * order) - 1), order - 1)
        self.grams.append(keys)
        self.bits.append(np.where(counts > 0, own, escapes[:, of] + lower).astype(np.float32))
        self.contexts.append(contexts)
        self.escapes.append(escapes.astype(np.float32))
        self._index()

    def _index(self) -> None:
        self._known = [_Lookup(keys) for keys in self.grams]
        self._known_contexts = [_Lookup(keys) for keys in self.contexts]

    def __getstate__(self) -> dict:
        """Only what was learnt travels; the lookup tables are made where it arrives."""
        return {name: value for name, value in vars(self).items() if not name.startswith("_")}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self._index()

    def code_lengths(self, codes: np.ndarray, order: int) -> np.ndarray:
        """Bits (languages x codes) of the last byte of each code in a context of ``order``."""
        if order < 0:
            return np.full((len(self.languages), len(codes)), 8.0, dtype=np.float32)
        place, known = self._known[order](codes)
        result = self.bits[order][:, place]
        rest = np.flatnonzero(~known)
        if len(rest):
            result[:, rest] = self._unknown(codes[rest], order)
        return result

    def _unknown(self, codes: np.ndarray, order: int) -> np.ndarray:
        """The same for codes that no language has seen at this order."""
        place, known = self._known_contexts[order](codes >> np.uint32(8))
        escape = np.where(known, self.escapes[order][:, place], np.float32(0))
        shorter = codes & np.uint32((1 << 8 * order) - 1)
        return escape + self.code_lengths(shorter, order - 1)

    def _sums(self, codes: np.ndarray, breaks: np.ndarray, order: int) -> np.ndarray:
        """Bits (texts x languages) of codes that belong to the texts starting at ``breaks``."""
        place, known = self._known[order](codes)
        rest = np.flatnonzero(~known)
        place[rest] = 0
        extra = self._unknown(codes[rest], order)
        result = np.empty((len(breaks), len(self.languages)))
        for k, own in enumerate(self.bits[order]):
            bits = own[place]
            bits[rest] = extra[k]
            result[:, k] = np.add.reduceat(bits, breaks, dtype=np.float64)
        return result

    def text_bits(self, texts: list[bytes], most_context: int | None = None) -> np.ndarray:
        """Code length (texts x languages) of texts of one byte or more, each as a whole, in
        contexts of the trees' order, or of ``most_context`` bytes."""
        order = self.order if most_context is None else min(most_context, self.order)
        if len(texts) > 1:
            run = np.frombuffer(b"".join(texts), dtype=np.uint8)
            sizes = np.array([len(text) for text in texts])
            breaks = np.cumsum(sizes) - sizes
            return self._sums(_grams(run, breaks, order), breaks, order)
        run, first = np.frombuffer(texts[0], dtype=np.uint8), np.array([0])
        total = np.zeros((1, len(self.languages)))
        for start in range(0, len(run), _BYTES_AT_ONCE):  # a long text, with its context, in parts
            before = max(0, start - order)
            codes = _grams(run[before : start + _BYTES_AT_ONCE], first, order)
            total += self._sums(codes[start - before :], first, order)
        return total


@dataclass
class Languages:
    """The trees of all languages, in blocks."""

    blocks: list[ContextTrees]

    @property
    def languages(self) -> list[str]:
        return [language for block in self.blocks for language in block.languages]

    def text_bits(self, texts: list[bytes], most_context: int | None = None) -> np.ndarray:
        """Code length (texts x languages) of texts of one byte or more, each as a whole."""
        return np.hstack([block.text_bits(texts, most_context) for block in self.blocks])

    def fit(self, texts: list[bytes]) -> np.ndarray:
        """Whether the letters of each text are those of a language: coded by them alone it takes
        ``_MOST_BITS`` a byte or less, where any bytes take 8.

        What a text is about shows in longer contexts only, so that one on a topic never seen
        fits as well; other scripts, and letters in no order of the language, cost more.
        """
        bits = self.text_bits(texts, _LETTERS).min(axis=1)
        return bits <= _MOST_BITS * np.array([len(text) for text in texts])

    def passes(self) -> list[Languages]:
        """The same in parts that hold a bounded number of grams, or one block each."""
        parts: list[list[ContextTrees]] = []
        room = 0
        for block in self.blocks:
            cells = sum(bits.size for bits in block.bits)
            if not parts or cells > room:
                parts.append([])
                room = _CELLS_AT_ONCE
            parts[-1].append(block)
            room -= cells
        return [Languages(part) for part in parts]


def _sample(rows: DataFrame, sample_bytes: int) -> DataFrame:
    """``lang, text``: about ``sample_bytes`` of whole distinct texts of each language."""
    chance = F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 30))
    distinct = rows.select(
        "lang", *content_key(F.col("text")), F.octet_length("text").alias("size"), chance.alias("chance")
    ).distinct()
    share = F.least(F.lit(1.0), sample_bytes / F.sum("size")) * (1 << 30)
    # At least the text of the smallest hash, however long, stands for a language.
    limits = distinct.groupBy("lang").agg(
        F.greatest(F.min("chance"), F.floor(share).cast("bigint")).alias("limit")
    )
    joined = rows.join(F.broadcast(limits), "lang")
    return joined.where(chance <= F.col("limit")).select("lang", "text").distinct()


def learn(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = 3,
    sample_bytes: int = 1 << 20,
    max_grams: int = 200_000,
) -> Languages:
    """Context trees of every language from a bounded sample of labelled rows.

    Bounds, all documented parameters: about ``sample_bytes`` of whole distinct texts per
    language, chosen by a hash of the text; the ``max_grams`` most frequent grams per language
    and order. Grams are counted by Spark; only these bounded counts reach the driver, a block
    of languages at a time. Rows without text or language teach nothing; any number of
    languages is learnt, and how often a text is repeated does not matter.
    """
    if order > 3:
        raise ValueError("a context and its byte fill 32 bits: order is 3 at most")
    rows = labelled.select(
        column(text_col).alias("text"), column(lang_col).cast("string").alias("lang")
    ).where("text is not null and lang is not null and text <> ''")
    sample = materialize(_sample(rows, sample_bytes), "language-sample")

    def count(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = batch.column("text").to_pylist()
            for lang in set(langs):
                own = [texts[i].encode() for i in np.flatnonzero(langs == lang)]
                run = np.frombuffer(b"".join(own), dtype=np.uint8)
                breaks = np.cumsum([0, *map(len, own)])[:-1]
                for size in range(order + 1):
                    keys, counts = np.unique(_grams(run, breaks, size), return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([lang] * len(keys), pa.string()),
                            "size": pa.array(np.full(len(keys), size), pa.int32()),
                            "gram": pa.array(keys.astype(np.int64)),
                            "n": pa.array(counts.astype(np.int64)),
                        }
                    )

    place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("total"), "gram"))
    counted = (
        sample.mapInArrow(count, "lang string, size int, gram bigint, n bigint")
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("total"))
        .withColumn("place", place)
        .where(F.col("place") <= max_grams)
        .drop("place")
    )
    counted = materialize(counted, "grams")
    languages = sorted(row["lang"] for row in sample.select("lang").distinct().collect())
    blocks = []
    for start in range(0, len(languages), _LANGUAGES_AT_ONCE):
        block = languages[start : start + _LANGUAGES_AT_ONCE]
        top = counted.where(F.col("lang").isin(block)).toPandas()
        trees = ContextTrees(block, order)
        for size in range(order + 1):
            own = top[top["size"] == size]
            keys, at = np.unique(own["gram"].to_numpy(np.uint32), return_inverse=True)
            total = np.zeros((len(block), len(keys)))
            total[np.searchsorted(block, own["lang"].to_numpy(str)), at] = own["total"]
            trees.add(keys, total)
        blocks.append(trees)
    discard(sample)
    discard(counted)
    return Languages(blocks)


def identify(
    documents: DataFrame,
    trees: Languages,
    text_col: str = "text",
    horizon: int = 64,
    carry: list[str] | None = None,
) -> DataFrame:
    """``row`` (the document's columns, or those in ``carry``), ``lang_pred``, ``score``, ``fits``.

    Every byte of every text counts. ``score`` is the posterior of the winning language
    among the learnt ones, its evidence scaled to ``horizon`` bytes: it tells clear from mixed
    texts however long they are. ``fits`` is whether the letters are a learnt language's, by contexts
    of one byte: it tells texts of any learnt language, whatever they are about, from other
    scripts and noise. Of equal code lengths the language first by code
    point wins. Trees too large to be held at once are applied one pass after the other.

    * A null text, one without a letter, and any text if no language was learnt, is ``und``
      with score 0 and does not fit.
    * Repeated rows get the same answer each; other columns ride along and are not read.
    """
    spark = documents.sparkSession
    state = packed_text(documents, text_col, carry, legible=column(text_col).rlike(r"\p{L}"))
    given = state.schema.fields
    answer = T.StructType.fromDDL("lang_pred string, score double, fits boolean, best double").fields
    passes = trees.passes() or [trees]
    before = None
    for number, part in enumerate(passes):
        last = number + 1 == len(passes)
        kept = [given[0]] if last else given
        judge = _judge(spark.sparkContext.broadcast(part), text_col, horizon, [x.name for x in kept])
        state = state.mapInArrow(judge, T.StructType([*kept, *answer]))
        if not last:
            state = materialize(state, "languages")
            if before is not None:
                discard(before)
            before = state
    return state.drop("best")


def _judge(shared, text_col: str, horizon: int, kept: list[str]):
    """A function over batches that compares the languages of one part with those before."""

    def judge(batches):
        trees = shared.value
        languages = trees.languages
        for batch in batches:
            texts = batch_texts(batch, text_col)
            legible = batch.column("legible").to_pylist() if languages else []
            if "best" in batch.schema.names:
                langs, scores, fits, best = (
                    batch.column(name).to_pylist() for name in ("lang_pred", "score", "fits", "best")
                )
            else:
                langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                fits, best = [False] * len(texts), [float("inf")] * len(texts)
            for group in _groups([i for i, x in enumerate(legible) if x], texts):
                bits = trees.text_bits([texts[i] for i in group])
                winner, least = bits.argmin(axis=1), bits.min(axis=1)
                sizes = np.array([len(texts[i]) for i in group])
                scale = np.minimum(1, horizon / sizes)
                old = np.array([best[i] for i in group])
                new = np.minimum(old, least)
                mass = np.exp2((new - old) * scale)
                mass[np.isfinite(old)] /= [scores[i] for i in group if np.isfinite(best[i])]
                mass += np.exp2((new[:, None] - bits) * scale[:, None]).sum(axis=1)
                close = trees.fit([texts[i] for i in group])
                for j, i in enumerate(group):
                    if least[j] < old[j]:
                        langs[i] = languages[winner[j]]
                    fits[i] = fits[i] or bool(close[j])
                    scores[i], best[i] = float(1 / mass[j]), float(new[j])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in kept),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(fits, pa.bool_()),
                    pa.array(best, pa.float64()),
                ],
                names=[*kept, "lang_pred", "score", "fits", "best"],
            )

    return judge


def _groups(places: list[int], texts: list[bytes]) -> list[list[int]]:
    """Runs of texts of about ``_BYTES_AT_ONCE`` bytes; a longer text is a run of its own."""
    groups: list[list[int]] = []
    room = 0
    for i in places:
        if not groups or len(texts[i]) > room:
            groups.append([])
            room = _BYTES_AT_ONCE
        groups[-1].append(i)
        room -= len(texts[i])
    return groups


def drop_unidentified(
    documents: DataFrame, trees: Languages, least_score: float = 0.4, **options
) -> DataFrame:
    """``documents`` without those of no learnt language, or of none clearly; same columns.

    Null texts and those without a letter go, and all of them if no language was learnt. Repeated
    rows stay or go together; other columns of any name ride along, none is read; an empty table
    stays empty.
    """
    found = identify(documents, trees, **options)
    known = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score) & F.col("fits")
    return unpacked(found.where(known), documents)


def is_held_out(doc_id: Column) -> Column:
    """The quarter of the documents by id that nothing is learnt from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
