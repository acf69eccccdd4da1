"""Spelling variants: frequent words and the rare ones a single edit away.

Every word is cut into bigrams, and these are ordered by how many words hold them, rarest
first. Its prefix is its three rarest bigrams (and any as rare as the third); a dynamic program
picks two disjoint ones of the prefix with the least sum of frequencies, its pivots. One edit
destroys at most one of two disjoint bigrams. Of two words one edit apart, take the one whose
prefix ends earlier in the order: the pivots of it that the edit spares stand in the other
word's prefix. So pivots are looked up in an index of prefixes.

A bigram alone would bring all words that hold it together. What the edit spares besides limits
the look-up: with both pivots spared, all that lies on the far side of them, with one destroyed,
all but its two letters. In the index every word has an entry for each place an edit may be:
about 40 short texts a word, whatever the number of words.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitloom.llm.frames import ascii_lower, column
from transitloom.storage import discard, materialize

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 7
LEAST_COUNT = 2
LEAST_RATIO = 10
WORDS_A_TASK = 20_000
_PREFIX = 3  # bigrams, of which two are disjoint whatever their places


def runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, run``: every run of letters of the texts, in lower case (A-Z only).

    Null texts have no runs; repeated rows have theirs each; an empty table gives no rows.
    """
    found = documents.select(
        column(id_col).alias("doc_id"),
        F.explode(F.regexp_extract_all(column(text_col), F.lit(RUN), F.lit(0))).alias("run"),
    )
    return found.select("doc_id", ascii_lower(F.col("run")).alias("run"))


def misspelt(found: DataFrame, one_in: int = 31) -> DataFrame:
    """``word``: the runs, one letter deleted in one of ``one_in``, by a hash of id and run.

    A null id counts as empty inside the hash. The result may be an empty word.
    """
    code = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (code % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.select(F.when(code % one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the words of at least ``least_length`` letters with their number, if that is
    ``least_count`` or more. Counted before they are moved; nulls are no words."""
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def pivots(places: list[int], costs: list[int]) -> tuple[int, int]:
    """The two disjoint bigrams (places two apart or more) of least cost, by a table over places.

    ``places`` ascend. ``one[i]`` is the cheapest bigram of the first ``i``, and the best pair
    that ends at ``i`` joins it with the cheapest that ends before ``places[i]``.
    """
    one: list[tuple[int, int] | None] = [None]
    best, open_at = None, 0
    for place, cost in zip(places, costs, strict=True):
        while open_at < len(one) - 1 and places[open_at] <= place - 2:
            open_at += 1
        before = one[open_at]
        if before is not None and (best is None or (before[0] + cost, before[1], place) < best):
            best = (before[0] + cost, before[1], place)
        held = one[-1]
        one.append((cost, place) if held is None or (cost, place) < held else held)
    return best[1], best[2]


def _prefix(word: str, rank: dict[str, tuple[int, int]]) -> list[tuple[int, int]]:
    """Places and frequencies of the rarest bigrams. ``rank`` gives place in the order and
    frequency of every bigram."""
    grams = [(rank[word[k : k + 2]], k) for k in range(len(word) - 1)]
    bar = sorted(grams)[_PREFIX - 1][0]
    return [(k, own[1]) for own, k in grams if own <= bar]


def index_entries(word: str, rank: dict[str, tuple[int, int]]) -> set[str]:
    """The texts under which a word is found.

    Their marks tell what an edit has spared: ``<`` all from a place on, ``>`` all up to one,
    ``-`` both ends, ``*`` all but a gap. A number says how long the rest is, which one edit
    changes by one at most.
    """
    length = len(word)
    places = [k for k, _ in _prefix(word, rank)]
    index = {f"{word[k:]}<{k}" for k in places[:-1]}
    index.update(f"{word[: k + 2]}>{length - k - 2}" for k in places[1:])
    index.update(
        f"{word[: a + 2]}-{word[b:]}{b - a - 2}"
        for i, a in enumerate(places) for b in places[i + 1 :] if b >= a + 2
    )
    # A bigram of another word may have become one to three letters here; a bigram of the prefix
    # lies on one side.
    index.update(
        f"{word[:k]}*{word[k + gap :]}"
        for gap in (1, 2, 3)
        for k in range(length - gap + 1)
        if k + gap <= places[-1] or k >= places[0] + 2
    )
    return index


def look_ups(word: str, rank: dict[str, tuple[int, int]]) -> set[str]:
    """The index entries that a word looks up, by its pivots."""
    prefix = _prefix(word, rank)
    first, second = pivots([k for k, _ in prefix], [cost for _, cost in prefix])
    looked = {f"{word[:k]}*{word[k + 2 :]}" for k in (first, second)}
    for change in (-1, 0, 1):
        looked.add(f"{word[first:]}<{first + change}")
        looked.add(f"{word[: second + 2]}>{len(word) - second - 2 + change}")
        looked.add(f"{word[: first + 2]}-{word[second:]}{second - first - 2 + change}")
    return looked


def _bigram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank and frequency of every bigram: a row for each of 90 x 90 at most reaches the driver."""
    letters = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(letters, lambda at: F.substring("word", at, F.lit(2)))).alias("gram"))
    counted = sorted((row["n"], row["gram"]) for row in grams.groupBy("gram").agg(F.count("*").alias("n")).collect())
    return {gram: (place, n) for place, (n, gram) in enumerate(counted)}


def near_words(words: DataFrame) -> DataFrame:
    """``word, near``: all ordered pairs of ``words`` (distinct, of 4 letters at least, made of
    ``RUN`` in lower case) that differ by exactly one inserted, deleted or replaced letter.

    Whatever two words share an entry is compared. The entries of both sides are made where they
    are shuffled from and not stored. An empty table gives no pairs.
    """
    ranks = _bigram_ranks(words)
    # A word becomes some fifty rows: the tasks that make them get few words each.
    parts = max(1, -(-words.count() // WORDS_A_TASK))
    spread = words.select("word").repartition(parts, "word")

    def entries(make, name):
        def listed(batches):
            for batch in batches:
                keys, names = [], []
                for word in batch.column("word").to_pylist():
                    own = make(word, ranks)
                    keys += own
                    names += [word] * len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array(names, pa.string())], names=["entry", name]
                )

        return spread.mapInArrow(listed, f"entry string, {name} string")

    met = entries(look_ups, "word").join(entries(index_entries, "near"), "entry")
    one_edit = (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    there, back = F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"))
    pairs = met.where(one_edit).select(F.explode(F.array(there, back)).alias("pair"))
    return pairs.select("pair.*").distinct()


@dataclass(frozen=True)
class SpellingVariants:
    """``words``: ``word, form, root, n, n_near, form_n``; ``pairs``: ``word, near``."""

    words: DataFrame
    pairs: DataFrame


def group_variants(counted: DataFrame, least_ratio: int = LEAST_RATIO) -> SpellingVariants:
    """The form of every word of ``word, n`` (one row a word): of the words one edit away the one
    of largest ``n``, the smallest by code points among several, if its ``n`` is ``least_ratio``
    times the word's or more, else null. The root is where following forms ends.

    ``n_near`` counts all words one edit away, 0 if there are none. A word has a form at least
    ``least_ratio`` times as frequent, so following them ends after log ``n`` steps. Nulls are no
    words; an empty table gives no rows.
    """
    counted = materialize(counted, "words")
    pairs = materialize(near_words(counted), "near")
    numbers = counted.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # Least first: most frequent, then smallest by code points, as bytes of UTF-8 compare.
    found = pairs.join(numbers, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rarity"), "near")).alias("best")
    )
    often = -F.col("best.rarity") >= least_ratio * F.col("n")
    words = counted.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"),
        F.when(often, -F.col("best.rarity")).alias("form_n"),
    )
    words = materialize(words, "forms")
    rooted = words.join(_roots(words), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
    return SpellingVariants(rooted, pairs)


def _roots(words: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form; every round doubles the steps taken."""
    steps = materialize(words.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if steps.join(further, "root", "left_semi").isEmpty():
            return steps
        moved = steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        before, steps = steps, materialize(moved, "steps")
        discard(before)

