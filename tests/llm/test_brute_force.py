"""Operators that SQL cannot express, and general options, against plain Python."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from transitloom.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    html_extract,
    language_id,
    license_scan,
    line_dedup,
    mixture,
    sharding,
    simhash,
)
from transitloom.llm.html_blocks import blocks
from transitloom.llm.license_texts import KNOWN_TEXTS

SF = "/root/testdata/sf0.01"


def _texts(seed, count, words, vocabulary=5):
    rng = random.Random(seed)
    return [
        (k, " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(words))))
        for k in range(count)
    ]


@pytest.mark.parametrize("bounds", [{}, {"max_pairs": 7}, {"max_bytes": 150}])
def test_decontamination(spark, bounds):
    docs, items = _texts(1, 60, 30), [*_texts(2, 12, 8), (99, "w1 W2")]
    found = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        n=4,
        **bounds,
    ).collect()
    for row in found:
        words = row["row"]["text"].split()
        hit, names = set(), set()
        for item, text in items:
            own = text.lower().split()
            size = min(4, len(own))
            windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else ()
            for k in range(len(words)):
                if tuple(words[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    names.add(str(item))
        assert row["n_words"] == len(words)
        assert {w for s in row["spans"] for w in range(s["start"], s["end"])} == hit
        assert row["items"] == sorted(names)


def test_cut_spans_leaves_the_rest(spark):
    docs = spark.createDataFrame([(1, "Ä one, TWO three! end")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert decontaminate.cut_spans(docs, items).first()["text"] == "Ä ! end"


def _targets(sizes, weights, most):
    total, fixed = sum(sizes), {}
    while True:
        open_ = [k for k in range(len(sizes)) if k not in fixed]
        rest = total - sum(fixed.values())
        share = {k: rest * weights[k] / sum(weights[j] for j in open_) for k in open_}
        above = {k: most * sizes[k] for k in open_ if share[k] > most * sizes[k]}
        if not above:
            return [fixed.get(k, share.get(k)) for k in range(len(sizes))]
        fixed |= above


def test_mixture(spark):
    rng = random.Random(3)
    docs = []
    for source, count in (("a", 400), ("b", 30), ("c", 5), ("d", 300), (None, 200), ("zero", 3)):
        for _ in range(count):
            words = 0 if source == "zero" else rng.randrange(1, 40)
            docs.append((len(docs), " ".join(["x"] * words), source))
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    options = dict(block_words=500, shard_words=5_000, seed=5)
    plan = mixture.plan_mixture(frame, **options)
    order = ["a", "b", "c", "d", "zero", None]
    sizes = [sum(len(t.split()) for _, t, s in docs if s == source) for source in order]
    expected = dict(zip(order, _targets(sizes, [1, 2, 3, 1, 2, 3], 3), strict=True))
    taken, shards = Counter(), defaultdict(Counter)
    source_of = {k: s for k, _, s in docs}
    for row in mixture.placements(plan.sized, plan).collect():
        source = source_of[row["doc_id"]]
        assert row["target"] == pytest.approx(expected[source])
        assert len(row["draws"]) <= 3
        taken[source] += row["size"] * len(row["draws"])
        for draw in row["draws"]:
            shards[draw["shard"]][source] += row["size"]
    half = max(len(text.split()) for _, text, _ in docs) / 2
    for source, target in expected.items():  # whole documents cannot always come nearer
        assert abs(taken[source] - target) <= half, source
    assert len(shards) == plan.shards == 4
    whole = sum(taken.values())
    for shard in shards.values():  # a fair share of everything in each
        assert 0.5 < sum(shard.values()) * plan.shards / whole < 1.6
    again = mixture.plan_mixture(frame.repartition(5), **options)
    first = mixture.mixed(frame, plan, seed=5).select("shard", "row.doc_id")
    assert rows(first) == rows(mixture.mixed(frame, again, seed=5).select("shard", "row.doc_id"))
    assert first.count() == sum(len(r["draws"]) for r in mixture.placements(plan.sized, plan).collect())


def test_hypergeometric_draws(spark):
    total, marked, drawn, draws = 60, 22, 17, 4000
    picks = spark.range(draws).select(
        mixture.hypergeometric(
            F.lit(total), F.lit(marked), F.lit(drawn), (F.col("id") + 0.5) / draws
        ).alias("k")
    )
    found = Counter(row["k"] for row in picks.collect())
    for k in range(drawn + 1):
        chance = math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn)
        assert abs(found[k] / draws - chance) < 2 / draws
    edges = spark.createDataFrame([(5, 5, 2), (5, 0, 2), (7, 3, 7), (7, 3, 0), (0, 0, 0)], "n int, k int, d int")
    edge = edges.select(mixture.hypergeometric(F.col("n"), F.col("k"), F.col("d"), F.lit(0.9)).alias("x"))
    assert [row["x"] for row in edge.collect()] == [2, 0, 3, 0, 0]


def test_line_dedup(spark):
    rng = random.Random(4)
    docs = []
    for k in range(60):
        lines = [rng.choice(["", "a", "b b", "c c c", " d", f"own {k}"]) for _ in range(rng.randrange(14))]
        docs.append((k, "\n".join(lines)))
    least = 5
    sequences = {}
    for doc, text in docs:
        filled = [(n, line.strip()) for n, line in enumerate(text.split("\n")) if line.strip()]
        sequences[doc] = filled
    seen, gone = {}, defaultdict(set)
    for doc, filled in sequences.items():
        for i, j in itertools.combinations(range(len(filled) + 1), 2):
            run = tuple(line for _, line in filled[i:j])
            if sum(len(line.split()) for line in run) >= least:
                first = seen.setdefault(run, (doc, i))
                if first != (doc, i):
                    gone[doc] |= {n for n, _ in filled[i:j]}
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for row in line_dedup.deduplicated_lines(frame, min_words=least).collect():
        doc, text = row["row"]
        left = [line for n, line in enumerate(text.split("\n")) if n not in gone[doc]]
        assert row["kept_text"] == "\n".join(left)
        assert row["n_removed"] == len(gone[doc])


def test_license_variants(spark):
    mit = next(text for name, text in KNOWN_TEXTS if name == "MIT")
    variants = [
        mit.upper().replace("COPYRIGHT (C) <YEAR> <COPYRIGHT HOLDERS>", "Copyright 2020 Jane Doe"),
        mit.replace("\n", "\r\n").replace("copy, ", "copy; "),
        mit.replace("\n\n", "\n").replace("License", "Licence").replace("sublicense", "sub-licence"),
        "Some prose.\nreleased under the MIT licence\nMore prose.",
        mit.replace("WITHOUT WARRANTY", "WITH WARRANTY"),
    ]
    docs = spark.createDataFrame(list(enumerate(variants)), "doc_id long, text string")
    found = license_scan.scan_licenses(docs, license_scan.known_licenses(spark))
    result = {row["doc_id"]: (row["license"], row["notices"]) for row in found.collect()}
    assert result == {0: ("MIT", ""), 1: ("MIT", ""), 2: ("MIT", ""), 3: (None, "MIT"), 4: (None, "")}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_tells_collisions_apart(spark, keep):
    docs = [(k, text) for k, text in enumerate(["ab", "ac", "ab", None, "", "b", "ac", "ab"])]
    docs.append((7, "ab"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    weak = lambda text: F.substring(text, 1, 1)
    found = exact_dedup.exact_duplicates(frame, keep=keep, digest=weak).collect()
    groups = defaultdict(list)
    for doc, text in docs:
        groups[text or ""].append(doc)
    pick = min if keep == "smallest" else max
    expected = Counter((d, pick(g), len(g)) for g in groups.values() for d in g)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == len(groups)
    assert all(r["kept"] <= (r["doc_id"] == r["keep_id"]) for r in found)


def test_a_directory_of_several_steps_is_looked_up_at_once(spark):
    sizes = spark.createDataFrame(
        [(0, 60), (1 << 50, 60), (1 << 59, 60)], "bits bigint, size bigint"
    )
    steps = sharding.shard_directory(sizes, 100)
    assert len(steps) > 1
    found = {row["cell"]: row["leaves"] for row in sharding._leaves_by_cell(steps).collect()}
    assert set(map(tuple, found[0])) == {(10, 0, False), (10, 1, False)}
    assert set(map(tuple, found[8])) == {(1, 1, False)}


def test_shards_fit_and_are_as_large_as_they_can_be(spark):
    docs = [(k, "x" * (k % 50)) for k in range(400)] + [(1000, "y" * 90)] * 30 + [(2000, "z" * 900)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    limit = 500
    found = sharding.shard(frame, limit, row_bytes=0, carry=["doc_id"]).collect()
    assert Counter(r["row"]["doc_id"] for r in found) == Counter(k for k, _ in docs)
    sizes = defaultdict(int)
    for row in found:
        sizes[row["shard"]] += row["size"]
    over = {shard for shard, size in sizes.items() if size > limit}
    assert over == {r["shard"] for r in found if r["row"]["doc_id"] == 2000}
    assert len({r["shard"] for r in found if r["row"]["doc_id"] == 1000}) == 6
    base = sharding.start_depth(sum(len(t) for _, t in docs), limit)
    plain = {shard: size for shard, size in sizes.items() if "-" not in shard}
    for shard in plain:  # a bucket below its directory's depth was too large before it split
        if len(shard) - 1 > base:
            parent = shard[:-1]
            assert sum(size for other, size in sizes.items() if other.startswith(parent)) > limit


def test_shards_are_written_and_read(spark, tmp_path):
    frame = spark.createDataFrame([(k, "x" * 40) for k in range(50)], "doc_id long, text string")
    sharded = sharding.shard(frame, 600)
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows(back, "doc_id", "shard") == rows(sharded.select("row.doc_id", "shard"))


def _ppm_bits(counts, text, order):
    """Code length of ``text`` under ``{context: Counter}``, byte by byte."""
    text = b"\0" * order + bytes(b + 32 if 65 <= b <= 90 else b for b in text)
    bits = 0.0
    for k in range(order, len(text)):
        for size in range(order, -1, -1):
            seen = counts.get(text[k - size : k])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if text[k] in seen:
                bits -= math.log2(seen[text[k]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark, monkeypatch):
    labelled = [("the cat and the hat", "en"), ("THE dog", "en"), ("le chat et le chien", "fr"), ("été", "fr")]
    trees = language_id.learn(spark.createDataFrame(labelled, "text string, lang string"))
    trained = {lang: defaultdict(Counter) for lang in trees.languages}
    for text, lang in labelled:
        own = b"\0" * 3 + bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
        for k in range(3, len(own)):
            for size in range(4):
                trained[lang][own[k - size : k]][own[k]] += 1
    texts = [b"the chat", b"x", "Été the cat".encode(), b"cat " * 50]
    expected = [[_ppm_bits(trained[lang], text, 3) for lang in trees.languages] for text in texts]
    assert np.allclose(trees.text_bits(texts), expected, rtol=1e-5)
    monkeypatch.setattr(language_id, "_BYTES_AT_ONCE", 7)
    alone = [trees.text_bits([text])[0] for text in texts]
    assert np.allclose(alone, expected, rtol=1e-5)


def test_languages_of_held_out_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    held_out = language_id.is_held_out(F.col("doc_id"))
    trees = language_id.learn(documents.where(~held_out), sample_bytes=1 << 17)
    found = language_id.identify(documents.where(held_out), trees)
    right = found.agg(F.avg((F.col("lang_pred") == F.col("row.lang")).cast("int"))).first()[0]
    assert right > 0.99
    assert language_id.drop_unidentified(documents, trees).count() == documents.count()


def _plain_simhash(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [words[k : k + size] for k in range(max(1, len(words) - size + 1))]
    codes = [xxhash.xxh64_intdigest(" ".join(run), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(code >> bit & 1 for code in codes) > len(codes))


def test_simhash_of_texts(spark):
    texts = [text for _, text in _texts(6, 30, 40)] + ["É one\x0btwo\xa0x THREE", "One", "", None]
    for text in texts:
        own = text.encode() if text is not None else None
        assert simhash.simhash(own) == _plain_simhash(text, 4)
    spark_hash = spark.createDataFrame([("é one two",)], "t string").select(F.xxhash64("t")).first()[0]
    assert spark_hash % 2**64 == xxhash.xxh64_intdigest("é one two", 42)


def test_every_near_pair_agrees_in_a_table():
    rng = random.Random(7)
    masks = simhash.covering_masks(list(range(64)), 4)
    assert len(masks) == 31
    for _ in range(3000):
        flips = sum(1 << bit for bit in rng.sample(range(64), rng.randrange(5)))
        assert any(not flips & mask for mask in masks)


def _components(values, radius):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    return Counter(frozenset(w for w in values if find(w) == find(v)) for v in values)


@pytest.mark.parametrize("bucket_rows", [16_384, 3])
def test_links_connect_all_near_fingerprints(spark, bucket_rows):
    rng = random.Random(8)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            flips = rng.sample(range(64), rng.randrange(9))
            values.add(centre ^ sum(1 << bit for bit in flips))
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    links = simhash.links_within(spark.createDataFrame(signed, "fp long"), 4, bucket_rows).collect()
    found = [(row["src"] % 2**64, row["dst"] % 2**64) for row in links]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    root = {v: {v} for v in values}
    for a, b in found:
        if root[a] is not root[b]:
            root[a] |= root[b]
            for v in root[b]:
                root[v] = root[a]
    assert Counter(frozenset(root[v]) for v in values) == _components(sorted(values), 4)


def test_near_duplicates_keep_one_of_each_group(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    repeated = documents.unionByName(documents.where("doc_id % 50 = 0"))
    marks = {row["doc_id"]: _plain_simhash(row["text"], 4) for row in documents.collect()}
    ids = defaultdict(set)
    for doc, mark in marks.items():
        ids[mark].add(doc)
    expected = {}
    for group in _components(sorted(ids), 4):
        members = set().union(*(ids[mark] for mark in group))
        expected |= {doc: min(members) for doc in members}
    found = simhash.near_duplicates(repeated).collect()
    assert {row["doc_id"]: row["component_id"] for row in found} == expected
    assert all(int(row["fingerprint"], 16) == marks[row["doc_id"]] for row in found)
    kept = simhash.drop_near_duplicates(repeated).select("doc_id").collect()
    assert sorted(row["doc_id"] for row in kept) == sorted(set(expected.values()))


_CONTENT = st.lists(
    st.sampled_from([*chat_format.CONTROL_STRINGS, "\\", "<", "|im_end|>", "s>", "\n", "[", "n", "é"])
).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(_CONTENT, _CONTENT), max_size=4))
def test_conversations_survive_the_round_trip(turns):
    parts = [chat_format.render_turn(role, text) for role, text in turns]
    rendered = "".join(part for part, _, _ in parts)
    assert chat_format.parse(rendered) == turns
    for (role, text), (part, start, end) in zip(turns, parts, strict=True):
        assert chat_format.unescaped(part[start:end]) == text
    inner = rendered.replace(chat_format.START, "").replace(chat_format.END, "")
    assert not any(string in inner for string in chat_format.CONTROL_STRINGS[2:])


@pytest.mark.parametrize("text", ["x", "<|im_start|>x", "<|im_start|>r\nx<|im_end|>", "<|im_start|>r\n</s><|im_end|>\n"])
def test_parser_refuses_what_is_no_conversation(text):
    with pytest.raises(chat_format.GrammarError):
        chat_format.parse(text)


def _longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("table_bits", [1 << 28, 4])
def test_common_subsequence(monkeypatch, table_bits):
    monkeypatch.setattr(html_extract, "_TABLE_BITS", table_bits)
    rng = random.Random(9)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in "ab")
        found = html_extract.common_subsequence(a, b)
        assert len(found) == _longest(a, b) and all(a[i] == b[j] for i, j in found)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(found))


def test_blocks_and_their_places():
    page = (
        '<html><body class="no-sidebar"><header>Site</header><div class=cookie-notice>We <b>use</b></div>'
        '<form><article class="post"><header><h1>T &amp; x</h1></header><p>One<p>Two\n <a href=x>link</a>'
        ' &lt;b&gt; &copy 5&nbsp;6<span class="ad">buy</span> tail<script>var a="</p>";</script>'
        '<div class="ad">x</div><!-- <p>no --><section id=comments><p>c</section></article></form>'
        '<aside>side</aside></body>'
    )
    found = [(b.text, b.furniture, b.rank) for b in blocks(page)]
    assert found == [
        ("Site", True, 0), ("We use", True, 0), ("T & x", False, 3), ("One", False, 3),
        ("Two link <b> © 5 6 tail", False, 3), ("x", True, 3), ("c", True, 3), ("side", True, 0),
    ]


def test_shared_lines_of_near_pages_go(spark):
    def page(k, own, title="Site"):
        return (k, f"http://h.org/news/{k}.html", f"<p>{title}<p>Read this too<div>{own}</div><p>Imprint")

    pages = [page(k, f"text {k}") for k in range(40)]
    pages += [(100, "http://other.org/a", "<p>Site<p>only one")]
    pages += [(k, f"http://copies.org/{k}", "<p>the same<p>everywhere") for k in range(200, 203)]
    articles = "<nav>Menu</nav><article><p>told {}<p>told twice<p><a href=/>More</a></article>"
    pages += [(k, f"http://marked.org/{k}", articles.format(k)) for k in range(300, 303)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    texts = {row["page_id"]: row["text"] for row in html_extract.extract_text(frame).collect()}
    assert all(texts[k] == f"text {k}" for k in range(40))
    assert texts[100] == "Site\nonly one" and texts[201] == "the same\neverywhere"
    assert all(texts[k] == f"told {k}\ntold twice" for k in range(300, 303))


def test_articles_of_the_pages_table(spark):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    expected = {}
    for row in pages.collect():
        inside = re.search(r"<article>(.*)</article>", row["html"], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1|br)>", inside)
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", part)).split()) for part in parts]
        expected[row["page_id"]] = "\n".join(line for line in lines if line)
    found = {row["page_id"]: row["text"] for row in html_extract.extract_text(pages).collect()}
    assert found == expected
