"""Languages: texts of none, many of them, and samples that repetition does not shrink."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from transitloom.llm import language_id

WORDS = 60


def _words(seed, alphabet):
    pick = random.Random(seed)
    return ["".join(pick.choices(alphabet, k=pick.randint(2, 8))) for _ in range(WORDS)]


def _text(words, seed, n=40):
    return " ".join(random.Random(seed).choices(words, k=n))


EN, FR = _words("en", "etaoinshrdlu"), _words("fr", "esaitnrulodcmpé")


@pytest.fixture(scope="module")
def two_languages(spark):
    rows = [(_text(EN, k), "en") for k in range(40)] + [(_text(FR, k), "fr") for k in range(40)]
    return spark.createDataFrame(rows, "text string, lang string")


def test_texts_of_no_learnt_language_go(spark, two_languages):
    trees = language_id.learn(two_languages)
    noise = random.Random(1)
    clean = [_text(EN, 1000), _text(FR, 1001), _text(EN, 1002, 3), _text(FR, 1003, 2000)]
    foreign = [
        "Все люди рождаются свободными и равными в своём достоинстве и правах. " * 3,
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια. " * 3,
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心" * 3,
        "".join(noise.choices("bcdfghjkmpqvwxz ", k=400)),
        "".join(noise.choices("0123456789abcdef", k=400)),
    ]
    docs = spark.createDataFrame([(text,) for text in clean + foreign], "text string")
    left = {row["text"] for row in language_id.drop_unidentified(docs, trees).collect()}
    assert left == set(clean)


def test_texts_of_other_topics_stay(spark):
    """Trees of the invented corpus, prose they have never seen, and noise."""
    corpus = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held_out = language_id.is_held_out(F.col("doc_id"))
    trees = language_id.learn(corpus.where(~held_out))
    noise = random.Random(2)
    prose = [
        "The committee will meet again on Thursday to discuss the budget and to vote on several proposals.",
        "My grandmother keeps chickens, a very old dog and two cats in the yard behind her kitchen.",
        "Photosynthesis converts carbon dioxide and water into glucose and oxygen by means of light.",
        "Der Vogel sitzt im Garten auf dem Zaun und singt ein kleines Lied, während die Kinder spielen.",
        "Le chat dort sur le canapé pendant que la pluie tombe doucement sur les toits de la vieille ville.",
        "Mañana por la mañana iremos al mercado para comprar verduras frescas, queso y un poco de pescado.",
    ]
    foreign = [
        "Все люди рождаются свободными и равными в своём достоинстве и правах.", "人人生而自由在尊严和权利上一律平等",
        "".join(noise.choices("bcdfghjkmpqvwxz ", k=400)), "".join(noise.choices("0123456789abcdef", k=400)),
        "".join(noise.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=400)),
    ]
    docs = spark.createDataFrame([(text,) for text in prose + foreign], "text string")
    left = {row["text"] for row in language_id.drop_unidentified(docs, trees).collect()}
    assert left == set(prose)
    # Of the corpus itself nothing that has a letter goes but what no language clearly wins.
    found = language_id.identify(corpus, trees, carry=["doc_id"])
    gone = found.where("lang_pred <> 'und' AND NOT fits").count()
    assert gone == 0
    kept = {row["doc_id"] for row in found.where("fits AND score >= 0.4").select("row.doc_id").collect()}
    assert {415, 6361, 6880, 8971, 9345, 9588, 309} <= kept


def test_one_learnt_language_refuses_others(spark, two_languages):
    trees = language_id.learn(two_languages.where("lang = 'en'"))
    docs = spark.createDataFrame([(_text(EN, 2000),), ("Все люди рождаются свободными",)], "text string")
    assert language_id.drop_unidentified(docs, trees).count() == 1


def test_more_than_sixty_four_languages(spark, monkeypatch):
    words = {f"l{k:02}": _words(f"l{k}", "abcdefghijklmnopqrstuvwxyz") for k in range(70)}
    rows = [(_text(own, k), lang) for lang, own in words.items() for k in range(3 if lang < "l64" else 2)]
    trees = language_id.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert trees.languages == sorted(words)
    docs = spark.createDataFrame(
        [(_text(own, 99), lang) for lang, own in words.items()], "text string, lang string"
    )
    once = language_id.identify(docs, trees).orderBy("row.lang").collect()
    assert all(row["lang_pred"] == row["row"]["lang"] for row in once)
    monkeypatch.setattr(language_id, "_CELLS_AT_ONCE", 1)
    assert len(trees.passes()) == 9
    parts = language_id.identify(docs, trees).orderBy("row.lang").collect()
    assert [row["lang_pred"] for row in parts] == [row["lang_pred"] for row in once]
    assert np.allclose([row["score"] for row in parts], [row["score"] for row in once])


def test_grams_are_ranked_in_each_language(spark):
    rows = [(_text(EN, k), "en") for k in range(200)] + [(_text(FR, 0, 20), "fr")]
    trees = language_id.learn(spark.createDataFrame(rows, "text string, lang string"), max_grams=50)
    (block,) = trees.blocks
    known = set(block.grams[3].tolist())
    own = np.frombuffer(_text(FR, 0, 20).encode(), dtype=np.uint8)
    found = set(language_id._grams(own, np.array([0]), 3).tolist())
    assert len(known & found) >= 50


def test_copies_do_not_shrink_the_sample(spark, two_languages):
    copies = spark.createDataFrame([(_text(EN, 0, 200), "en")], "text string, lang string")
    hot = two_languages.unionByName(copies.crossJoin(spark.range(2000)).drop("id"))
    plain = two_languages.unionByName(copies)
    first, second = (language_id.learn(x, sample_bytes=6000) for x in (plain, hot))
    (first,), (second,) = (getattr(x, "blocks", [x]) for x in (first, second))
    assert [keys.tolist() for keys in first.grams] == [keys.tolist() for keys in second.grams]
