"""Spelling variants against every pair of words, and what the look-ups promise."""

import random
import re
import zlib
from itertools import combinations, pairwise

import pytest

from tests.conftest import rows
from transitloom.llm import spelling


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def _edited(random_, word, letters):
    k, kind = random_.randrange(len(word)), random_.randrange(3)
    return word[:k] + ("" if kind == 0 else random_.choice(letters)) + word[k + (kind != 2) :]


def _words(random_, n, letters, least=4):
    words = {"".join(random_.choices(letters, k=random_.randrange(least, 12))) for _ in range(n)}
    return sorted(words | {_edited(random_, word, letters) for word in list(words) if len(word) > least})


@pytest.mark.parametrize("letters", ["ab", "abcdé", "aeiourstlnÿ÷"])
def test_every_near_pair_shares_an_entry(letters):
    random_ = random.Random(len(letters))
    words = _words(random_, 250, letters)
    grams = {}
    for word in words:
        for gram in map("".join, pairwise(word)):
            grams[gram] = grams.get(gram, 0) + 1
    order = sorted((n, gram) for gram, n in grams.items())
    rank = {gram: (place, n) for place, (n, gram) in enumerate(order)}
    entries = {word: (spelling.index_entries(word, rank), spelling.look_ups(word, rank)) for word in words}
    for a, b in combinations(words, 2):
        if _one_edit(a, b):
            assert entries[a][0] & entries[b][1] or entries[a][1] & entries[b][0]


def test_pivots_are_the_cheapest_disjoint_pair():
    random_ = random.Random(5)
    for _ in range(500):
        places = sorted(random_.sample(range(12), random_.randrange(3, 8)))
        costs = [random_.randrange(6) for _ in places]
        cost = dict(zip(places, costs))
        first, second = spelling.pivots(places, costs)
        assert second - first >= 2
        cheapest = min(cost[a] + cost[b] for a, b in combinations(places, 2) if b - a >= 2)
        assert cost[first] + cost[second] == cheapest


def _expected(counts):
    near = {word: [other for other in counts if _one_edit(word, other)] for word in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best and counts[best] >= 10 * counts[word] else None

    def root(word):
        return root(form[word]) if form[word] else word

    return sorted(
        ((word, form[word], root(word), n, len(near[word]), counts.get(form[word])) for word, n in counts.items()),
        key=repr)


def test_variants_against_every_pair(spark):
    random_ = random.Random(7)
    words = _words(random_, 120, "abcé", least=4)
    counts = {word: random_.choice([1, 2, 3, 30, 40, 400, 5000]) for word in words}
    # A chain of forms, and ties for the most frequent one.
    counts |= {"aaaaaaaa": 1, "aaaaaaab": 10, "aaaaaabb": 100, "aaaaabbb": 1000, "zzzz": 2, "zzzy": 50, "zzzé": 50}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    variants = spelling.group_variants(frame)
    found = rows(variants.words, "word", "form", "root", "n", "n_near", "form_n")
    assert found == _expected(counts)
    by_word = {row[0]: row for row in found}
    assert by_word["aaaaaaaa"][2] == "aaaaabbb" and by_word["zzzz"][1] == "zzzy"


def test_words_of_documents(spark):
    texts = [
        (1, "Schöne GRÖßE, schÖne große×mal 12abcdefgh_abcdefghi"), (1, "Schöne GRÖßE"), (None, "abcdefgh abcdefgh"),
        (3, None), (4, ""), (5, "short words are no w0rds"), (6, "Ω" + "x" * 50_000 + " abcdefgh"),
    ]
    texts += [(k, "abcdefgh wonderful WONDERFUL.") for k in range(100)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").selectExpr("*", "1 AS run", "2 AS word")
    expected = {}
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda letter: letter[0].lower(), run)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if code % 31 == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            expected[run] = expected.get(run, 0) + 1
    found = spelling.vocabulary(spelling.misspelt(spelling.runs(frame)))
    assert rows(found) == sorted(
        ((word, n) for word, n in expected.items() if n >= 2 and len(word) >= 7), key=repr)
    empty = spelling.vocabulary(spelling.misspelt(spelling.runs(frame.limit(0))))
    assert spelling.group_variants(empty).words.count() == 0
