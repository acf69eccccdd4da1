"""The rows of the pipeline against a plain version of its stages, one after the other."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from transitloom.llm import language_id, mixture

SF = "/root/testdata/sf0.001"


def _fingerprint(text):
    lower = re.sub("[A-Z]", lambda letter: letter[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    if not shingles:
        return 0
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], dtype=np.uint64)
    bits = [(int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) * 2 > len(hashes)) for b in range(64)]
    return sum(1 << b for b, on in enumerate(bits) if on)


def _one_of_each_group(docs):
    """Documents whose id is the smallest that links of at most four bits lead to."""
    prints = [(row["doc_id"], _fingerprint(row["text"])) for row in docs]
    root = {key: key for key, _ in prints}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    for k, (a, x) in enumerate(prints):
        for b, y in prints[:k]:
            if (x ^ y).bit_count() <= 4:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [row for row in docs if find(row["doc_id"]) == row["doc_id"]]


def _words(text):
    lower = re.sub("[A-Z]", lambda letter: letter[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def _clean(docs, items):
    windows = set()
    for item in items:
        words = _words(item)
        n = min(13, len(words))
        windows |= {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
    sizes = {len(window) for window in windows}
    kept = []
    for row in docs:
        words, hit = _words(row["text"]), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(words)):
            kept.append(row)
    return kept


@pytest.fixture(scope="module")
def whole(spark):
    return corpus_pipeline.run(spark, SF).collect()


def test_rows_of_the_pipeline(spark, whole):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    trees = language_id.learn(documents.where(~language_id.is_held_out(F.col("doc_id"))))
    named = language_id.identify(documents, trees).where("lang_pred <> 'und' AND score >= 0.4 AND fits")
    docs = [row["row"] for row in named.collect()]
    docs = _clean(
        _one_of_each_group(docs), [row["text"] for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    left = spark.createDataFrame([tuple(row) for row in docs], documents.schema)
    plan = mixture.plan_mixture(left)
    taken = {
        row["doc_id"]: row["n"]
        for row in mixture.placements(plan.sized, plan).select("doc_id", F.size("draws").alias("n")).collect()
    }
    expected = Counter()
    for row in docs:
        expected[tuple(row)] += taken[row["doc_id"]]
    assert Counter(tuple(row)[:-1] for row in whole) == +expected
    # All rows fit one shard here, and every row has one.
    assert sum(len((row["text"] or "").encode()) + 32 for row in whole) < corpus_pipeline.SHARD_BYTES
    assert len({row["shard"] for row in whole}) == 1 and all(row["shard"] for row in whole)


def test_the_mix_comes_near_its_targets(whole):
    sizes = Counter()
    for row in whole:
        sizes[row["source"]] += len(re.findall("[^\x20\x09-\x0d]+", row["text"] or ""))
    assert len(sizes) > 1 and sum(sizes.values()) > 0
