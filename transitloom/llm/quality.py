"""Quality of texts by compression with dictionaries of good and of bad text.

Two Zstandard dictionaries are built, from text labelled good and from text labelled bad. A
text is compressed with each, in pieces small enough for the dictionary to matter in all of
them; the bytes that the good dictionary saves over the bad one, by the text's size, become a
probability by a logistic curve fitted on labelled text the dictionaries were not built from.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom.llm.frames import batch_texts, column, content_key, packed_text
from transitloom.storage import discard, materialize

PIECE_BYTES = 256
DICTIONARY_BYTES = 32 << 10
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 4 << 20
THRESHOLD = 0.3
_LEVEL = 3
_SAMPLE_PIECE = 512
_DAMPING = 64  # bytes added to a text's size, so that a few bytes of a short one say little


class Dictionary:
    """A compressor that knows a dictionary; goes to tasks as bytes and is set up there once."""

    def __init__(self, samples: list[bytes], size: int):
        self.trained = True
        try:
            self.content = zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:  # too little text to train on: the text itself serves
            self.trained, self.content = False, b"".join(samples)[-size:]

    def __getstate__(self):
        return {"trained": self.trained, "content": self.content}

    @cached_property
    def compressor(self) -> zstandard.ZstdCompressor:
        kind = zstandard.DICT_TYPE_FULLDICT if self.trained else zstandard.DICT_TYPE_RAWCONTENT
        data = zstandard.ZstdCompressionDict(self.content, dict_type=kind)
        data.precompute_compress(level=_LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=data, level=_LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
        )


@dataclass(frozen=True)
class QualityModel:
    """What ``learn`` returns: two dictionaries and the curve; without both kinds of labelled
    text there are no dictionaries, and the curve is the share of good labels."""

    dictionaries: tuple[Dictionary, Dictionary] | None
    slope: float
    offset: float

    def saving(self, text: bytes | None) -> float:
        """Bytes that the good dictionary saves over the bad one, by the size of the text."""
        return _saving(self.dictionaries, text)

    def score(self, text: bytes | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.saving(text) + self.offset, -500, 500))))


def _saving(dictionaries: tuple[Dictionary, Dictionary] | None, text: bytes | None) -> float:
    if not text or dictionaries is None:
        return 0.0
    good, bad = (dictionary.compressor.compress for dictionary in dictionaries)
    saved = 0
    for at in range(0, len(text), PIECE_BYTES):
        piece = text[at : at + PIECE_BYTES]
        saved += len(bad(piece)) - len(good(piece))
    return saved / (len(text) + _DAMPING)


def _logistic(values: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic curve, by Newton's method with a weak prior."""
    scale = float(values.std()) or 1.0
    inputs = np.stack([values / scale, np.ones_like(values)], axis=1)
    prior = np.array([1e-2, 1e-6]) * weights.sum() / len(weights)
    found = np.zeros(2)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ found, -500, 500)))
        slope = inputs.T @ (weights * (labels - chance)) - prior * found
        bend = inputs.T @ (inputs * (weights * chance * (1 - chance))[:, None]) + np.diag(prior)
        step = np.linalg.solve(bend, slope)
        # A step no longer than 2: far away the curve is flat and a whole one overshoots.
        found = found + step * min(1.0, 2 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return float(found[0] / scale), float(found[1])


def learn(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> QualityModel:
    """The model that tells texts labelled 1 from texts labelled 0.

    Learns from a bounded sample: of each label the ``sample_rows`` ids first in the order of a
    hash, broadcast to the documents, and of their different texts ``sample_bytes`` in pieces,
    which the driver gets. Everything else follows from all labels: their numbers weigh the
    sample. The curve is fitted on texts scored by dictionaries of the other half of the sample;
    the dictionaries kept are built from all of it.

    * Rows without id, label or text, and empty texts, teach nothing. Of labels other than 0
      and 1 nothing is learnt. A document with several labels counts for each.
    * Repeated rows and equal texts of one label count once. Extra columns are ignored.
    * Empty tables, or one label only, give a model whose score is the (smoothed) share of
      good labels for every text.
    """
    known = labels.select(
        column(id_col).alias("id"), column(label_col).cast("int").alias("label")
    ).where("id IS NOT NULL AND label IN (0, 1)").distinct()
    sampled, numbers = [], {}
    for label in (0, 1):
        own = known.where(F.col("label") == label)
        numbers[label] = own.count()
        sampled.append(own.orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    prior = float(np.log((numbers[1] + 1) / (numbers[0] + 1)))
    if not all(numbers.values()):
        return QualityModel(None, 0.0, prior)

    few = materialize(sampled[0].unionByName(sampled[1]), "labels")  # twice sample_rows at most
    text = column(text_col)
    texts = documents.where(text.isNotNull() & (text != "")).select(column(id_col).alias("id"), text.alias("text"))
    # Equal texts of a label meet by their hash, so that copies are one before they are moved.
    texts = texts.join(F.broadcast(few), "id").groupBy("label", *content_key(F.col("text")))
    texts = texts.agg(F.first("text").alias("text"))
    texts = materialize(texts.withColumn("half", F.pmod("key_a", F.lit(2))), "labelled")
    octets = F.encode("text", "utf-8")
    starts = F.sequence(F.lit(1), F.greatest(F.octet_length("text"), F.lit(1)), F.lit(_SAMPLE_PIECE))
    pieces = texts.select("label", "half", "key_a", "key_b", F.posexplode(
        F.transform(starts, lambda at: F.substring(octets, at, F.lit(_SAMPLE_PIECE)))
    ).alias("no", "piece"))
    parts = {}
    for label in (0, 1):
        order = F.xxhash64("key_a", "key_b", "no")
        own = pieces.where(F.col("label") == label).orderBy(order, "key_b", "no")
        for row in own.limit(sample_bytes // _SAMPLE_PIECE).select("half", "piece").collect():
            parts.setdefault((label, row["half"]), []).append(bytes(row["piece"]))

    def dictionaries(*halves):
        samples = [[piece for half in halves for piece in parts.get((label, half), [])] for label in (1, 0)]
        if not all(samples):
            return None
        return tuple(Dictionary(own, dictionary_bytes) for own in samples)

    whole = dictionaries(0, 1)
    if whole is None:
        discard(texts)
        return QualityModel(None, 0.0, prior)
    # What a text is judged by when the curve is fitted: the half it is not in.
    apart = {0: dictionaries(1) or whole, 1: dictionaries(0) or whole}

    def judge(batches):
        for batch in batches:
            halves = batch.column("half").to_pylist()
            savings = [
                _saving(apart[half], text)
                for half, text in zip(halves, batch.column("text").cast(pa.binary()).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(savings, pa.float64())], names=["label", "saving"]
            )

    judged = texts.select("label", "half", "text").mapInArrow(judge, "label int, saving double")
    rows = judged.orderBy("label", "saving").collect()  # a row per different text of the sample
    discard(texts)
    found = np.array([row["label"] for row in rows], dtype=float)
    share = {label: numbers[label] / max(1, (found == label).sum()) for label in (0, 1)}
    weights = np.where(found == 1, share[1], share[0])
    slope, offset = _logistic(np.array([row["saving"] for row in rows]), found, weights)
    return QualityModel(whole, slope, offset)


def score_quality(
    documents: DataFrame, model: QualityModel, text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """``row, score``: every row with the chance, 0 to 1, that its text is labelled 1.

    ``row`` holds all columns of ``documents``, or those in ``carry``. Whole texts are read, a
    piece at a time; nothing is shuffled, and equal texts get equal scores.

    * Null and empty texts save nothing: they get the curve's value at 0.
    * Repeated rows each get their score; columns of any name stay inside ``row``.
    * An empty table gives no rows.
    """
    rows = packed_text(documents, text_col, carry)

    def score(batches):
        for batch in batches:
            scores = [model.score(text) for text in batch_texts(batch, text_col)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores, pa.float64())], names=["row", "score"]
            )

    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(score, schema)


def drop_poor(
    documents: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``documents`` whose score is ``threshold`` or more, with their columns.

    Nulls, empty texts, repeated rows and an empty table as in ``score_quality``.
    """
    scored = score_quality(documents, model, text_col).where(F.col("score") >= threshold)
    return scored.select(*[column("row")[name].alias(name) for name in documents.columns])


def is_held_out(key: Column) -> Column:
    """Whether a document is kept from learning: one in five, by a hash of its id; a null is not."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))
