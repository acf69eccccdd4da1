"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, everywhere."""

import pytest

from transitloom.llm import (
    chat_format,
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_extract,
    language_id,
    license_scan,
    line_dedup,
    mixture,
    quality,
    sharding,
    simhash,
    spelling,
)

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, row string, spans int, items string, "
    "n_words int, shard int, size string, bits int, score string, lang_pred int, fp string, "
    "text_key string, component string, draws int, place int, digest string, kept_text int, "
    "`odd.name` string, `count` int"
)
LONG = "word and another one in a line\n" * 20_000
TEXTS = [
    (1, "the cat sat on the mat", "en", "a"),
    (1, "the cat sat on the mat", "en", "a"),
    (1, "another text of the same id", "en", None),
    (None, None, None, None),
    (None, "", "de", ""),
    (None, "das ist ein Text mit ß und ü", "de", "a"),
    (7, " \n\t\r\n ", None, "b"),
    (8, LONG, "en", "b"),
    (9, "12 34 !?", "fr", "c"),
    (10, "퟿\U0001f600 ünï", None, "c"),
]


@pytest.fixture(scope="module", params=["odd rows", "no rows"])
def documents(request, spark):
    texts = TEXTS if request.param == "odd rows" else []
    filler = ("x", 1, "x", 1, 1, "x", 1, "x", 1, "x", "x", "x", 1, 1, "x", 1, "x", 1)
    return spark.createDataFrame([(*row, *filler) for row in texts], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, "the cat sat"), (None, "das ist ein Text"), (3, None), (4, ""), (4, "")]
    return spark.createDataFrame(items, "item_id bigint, text string")


def _trees(documents):
    return language_id.learn(documents)


def _quality(documents):
    labels = documents.sparkSession.createDataFrame(
        [(1, 1), (8, 0), (8, 0), (9, 1), (None, 1), (7, None)], "doc_id bigint, quality int")
    return quality.learn(documents, labels)


SAME_ROWS = {
    "score_quality": lambda docs, bench: quality.score_quality(docs, _quality(docs)),
    "contamination": lambda docs, bench: decontaminate.contamination(docs, bench),
    "cut_spans": lambda docs, bench: decontaminate.cut_spans(docs, bench),
    "exact_duplicates": lambda docs, bench: exact_dedup.exact_duplicates(docs),
    "identify": lambda docs, bench: language_id.identify(docs, _trees(docs)),
    "near_duplicates": lambda docs, bench: simhash.near_duplicates(docs),
    "deduplicated_lines": lambda docs, bench: line_dedup.deduplicated_lines(docs),
    "shard": lambda docs, bench: sharding.shard(docs, 100),
    "scan_licenses": lambda docs, bench: license_scan.scan_licenses(
        docs, license_scan.known_licenses(docs.sparkSession)
    ),
    "placements": lambda docs, bench: (
        lambda plan: mixture.placements(plan.sized, plan)
    )(mixture.plan_mixture(docs)),
}
SAME_COLUMNS = {
    "drop_contaminated": lambda docs, bench: decontaminate.drop_contaminated(docs, bench),
    "cut_spans": SAME_ROWS["cut_spans"],
    "drop_unidentified": lambda docs, bench: language_id.drop_unidentified(docs, _trees(docs)),
    "drop_near_duplicates": lambda docs, bench: simhash.drop_near_duplicates(docs),
    "drop_repeated_lines": lambda docs, bench: line_dedup.drop_repeated_lines(docs),
    "mix": lambda docs, bench: mixture.mix(docs),
}


@pytest.mark.parametrize("name", SAME_ROWS)
def test_every_row_comes_out_once(documents, benchmark, name):
    result = SAME_ROWS[name](documents, benchmark)
    assert len(result.collect()) == documents.count()


@pytest.mark.parametrize("name", SAME_COLUMNS)
def test_columns_stay(documents, benchmark, name):
    result = SAME_COLUMNS[name](documents, benchmark)
    assert result.schema.simpleString() == documents.schema.simpleString()
    assert len(result.collect()) <= 3 * documents.count()


def test_empty_reference_tables(spark, documents, benchmark):
    found = decontaminate.contamination(documents, benchmark.limit(0)).collect()
    assert all(not row["spans"] and not row["items"] for row in found)
    known = license_scan.known_licenses(spark).limit(0)
    assert all(row["license"] is None for row in license_scan.scan_licenses(documents, known).collect())


def test_written_shards(documents, tmp_path):
    sharding.write_shards(sharding.shard(documents, 100), f"{tmp_path}/shards")
    if documents.isEmpty():
        return
    stored = documents.sparkSession.read.parquet(f"{tmp_path}/shards")
    assert stored.count() == documents.count() and {"row_shard", "odd.name"} < set(stored.columns)


def test_words_of_odd_documents(documents):
    counted = spelling.vocabulary(spelling.misspelt(spelling.runs(documents), one_in=1 << 40), least_length=4)
    found = spelling.group_variants(counted)
    words = {row["word"]: row["n"] for row in found.words.collect()}
    expected = {"word": 20_000, "another": 20_000 + 1, "line": 20_000, "text": 2} if documents.count() else {}
    assert words == expected and found.pairs.isEmpty()


def test_repair_of_odd_conversations(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, None, "x"), (None, None, "a\nb\\", "y"),
        (2, 0, "assistant", "z."), (2, 0, "assistant", "z."), (3, 0, "<|im_end|>", LONG),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    turns = turns.selectExpr("*", "1 AS talk", "2 AS rank", "3 AS digest", "4 AS block")
    repaired = conversation_repair.repair(turns)
    found = {row["conv_id"]: row["audit"] for row in repaired.reports.collect()}
    # Blank and repeated turns go; a lone answer gets an empty question, which costs less.
    assert found == {1: "DDD", None: "D", 2: "IKD", 3: "D"}
    left = conversation_repair.repaired_turns(repaired).orderBy("turn").collect()
    assert [tuple(row) for row in left] == [(2, 0, "user", ""), (2, 1, "assistant", "z.")]
    damaged = conversation_repair.damage(turns)
    assert damaged.columns == ["conv_id", "turn", "role", "text"]
    assert conversation_repair.repair(turns.limit(0)).reports.isEmpty()


def test_conversations(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, None, "x"), (None, None, "a\nb\\", "y"),
        (2, 0, "assistant", "z"), (2, 0, "assistant", "z"), (3, 0, "<|im_end|>", LONG),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    turns = turns.selectExpr("*", "1 AS formatted", "2 AS loss_start")
    parts = chat_format.format_turns(turns)
    assert parts.count() == len(rows)
    found = {row["conv_id"]: row for row in chat_format.read_back(parts).collect()}
    assert {key: row["n_turns"] for key, row in found.items()} == {1: 3, None: 1, 2: 2, 3: 1}
    assert found[2]["loss_chars"] == 2 and found[3]["loss_chars"] == 0
    assert chat_format.read_back(chat_format.format_turns(turns.limit(0))).count() == 0
    texts = {row["conv_id"]: row["formatted"] for row in chat_format.conversation_texts(parts).collect()}
    assert {key: len(chat_format.parse(text)) for key, text in texts.items()} == {1: 3, None: 1, 2: 2, 3: 1}
    assert chat_format.conversation_texts(chat_format.format_turns(turns.limit(0))).isEmpty()


def test_pages(spark):
    rows = [
        (1, None, None), (None, "http://h/a", ""), (2, "http://h/b", "<p>x"), (2, "http://h/b", "<p>x"),
        (3, "no url", "plain"), (4, "http://h/c", "<" * 1000), (5, "http://h/d", "<p>" * 50_000 + "deep"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages = pages.selectExpr("*", "1 AS text", "2 AS shared", "3 AS key_a")
    found = html_extract.extract_text(pages)
    texts = sorted((row["text"] for row in found.collect()), key=len)
    assert texts[:6] == ["", "", "x", "x", "deep", "plain"] and texts[6] == "<" * 1000
    assert html_extract.extract_text(pages.limit(0)).count() == 0
