"""The quality classifier on held-out labels, its curve, and odd input."""

import math
import pickle
import random
import zlib

import numpy as np
import pytest
import zstandard

from transitloom.llm import quality
from transitloom.llm.queries import corpus_queries

SF = "/root/testdata/sf0.1"


def _area(labels, scores):
    """Chance that a good text scores above a bad one; ties count half."""
    good = [score for label, score in zip(labels, scores) if label]
    bad = [score for label, score in zip(labels, scores) if not label]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_labels(spark):
    scored = corpus_queries()["op11_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").dropna()
    rows = scored.join(labels, "doc_id").collect()
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3) for row in rows)
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) for row in rows)
    held_out = [row for row in rows if row["held_out"]]
    found = [row["quality"] for row in held_out]
    scores = [row["score"] for row in held_out]
    assert _area(found, scores) > 0.98
    # Calibrated: the mean chance is near the share, among the uncertain ones too.
    assert abs(np.mean(scores) - np.mean(found)) < 0.03
    unsure = [(s, y) for s, y in zip(scores, found) if 0.05 < s < 0.95]
    assert abs(np.mean([s for s, _ in unsure]) - np.mean([y for _, y in unsure])) < 0.15
    right = np.mean([row["predicted"] == row["quality"] for row in held_out])
    assert right > 0.96


@pytest.fixture(scope="module")
def taught(spark):
    random_ = random.Random(1)
    good = ["the wind over the quiet hill and river " * 3, "a letter about the garden and its trees "]
    docs, labels = [], []
    for k in range(400):
        words = random_.choice(good).split()
        random_.shuffle(words)
        text = " ".join(words) if k % 4 else "$$ ".join(words).upper()
        docs.append((k, text, "x", 1.0))
        labels.append((k, int(k % 4 > 0)))
    labels += [(1, 0), (None, 1), (7, None), (8, 5), (10**6, 1), (2, 1)]
    docs += [(None, "nobody's text", "y", 0.0), (2, None, "y", 0.0), (2, "", "y", 0.0)]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string, row string, score double")
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int")
    return documents, labels, quality.learn(documents, labels)


def test_scores_are_those_of_the_dictionaries(taught):
    documents, _, model = taught
    kinds = {True: zstandard.DICT_TYPE_FULLDICT, False: zstandard.DICT_TYPE_RAWCONTENT}
    plain = []
    for dictionary in model.dictionaries:
        data = zstandard.ZstdCompressionDict(dictionary.content, dict_type=kinds[dictionary.trained])
        plain.append(zstandard.ZstdCompressor(
            level=3, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False))
    for row in quality.score_quality(documents, model).collect():
        text = (row["row"]["text"] or "").encode()
        pieces = [text[at : at + 256] for at in range(0, len(text), 256)]
        good, bad = (sum(len(one.compress(piece)) for piece in pieces) for one in plain)
        value = model.slope * (bad - good) / (len(text) + 64) + model.offset
        assert math.isclose(row["score"], 1 / (1 + math.exp(-value)), rel_tol=1e-9)


def test_learning_is_repeatable_and_tells_the_labels(taught):
    documents, labels, model = taught
    again = quality.learn(documents.repartition(5), labels.repartition(3))
    assert (again.slope, again.offset) == (model.slope, model.offset)
    assert [d.content for d in again.dictionaries] == [d.content for d in model.dictionaries]
    assert model.slope > 0
    assert model.score(b"the wind over the garden and the river") > 0.5 > model.score(b"THE$$ WIND$$ OVER$$ THE$$ HILL$$ " * 4)
    copy = pickle.loads(pickle.dumps(model))
    assert copy.score(b"a letter") == model.score(b"a letter")
    kept = quality.drop_poor(documents, model)
    assert kept.columns == documents.columns and 250 < kept.count() < 350


def test_odd_input(spark, taught):
    documents, labels, model = taught
    odd = [(1, None, "a", 1.0), (1, "", "a", 1.0), (2, "same", "a", 1.0), (2, "same", "b", 2.0),
           (3, "word " * 200_000, "a", 1.0), (4, "\u0000\U0001f600 ünï", "a", 1.0)]
    frame = spark.createDataFrame(odd, documents.schema)
    found = {(row["row"]["text"] or "")[:9]: row["score"] for row in quality.score_quality(frame, model).collect()}
    assert len(found) == 4 and all(0 <= score <= 1 for score in found.values())
    assert math.isclose(found[""], 1 / (1 + math.exp(-model.offset)))
    assert quality.score_quality(frame.limit(0), model).count() == 0
    for given in (labels.limit(0), labels.where("quality = 1")):
        flat = quality.learn(documents, given)
        scores = {row["score"] for row in quality.score_quality(frame, flat).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 1
    assert quality.learn(documents.limit(0), labels).dictionaries is None
