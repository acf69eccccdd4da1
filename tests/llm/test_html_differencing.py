"""Page differencing on hosts whose pages mark no article, against a plain version."""

import random
from itertools import groupby

import pytest

from transitloom.llm import html_extract

TEMPLATE = ["Home", "Contact us", "Copyright by the site"]


def _page(*lines, tag="div"):
    return "<html><body>" + "".join(f"<{tag}>{line}</{tag}>" for line in lines) + "</body></html>"


def _texts(spark, pages):
    frame = spark.createDataFrame(
        [(k, url, html) for k, (url, html) in enumerate(pages)], "page_id bigint, url string, html string")
    return {row["page_id"]: row["text"] for row in html_extract.extract_text(frame).collect()}


def test_copies_beside_each_other_lose_the_template(spark):
    copy = _page(TEMPLATE[0], "The story of a river and its many long bends", *TEMPLATE[1:])
    other = _page(TEMPLATE[0], "A quite different report on the price of bread", *TEMPLATE[1:])
    pages = [(f"http://h/a/{k}", copy) for k in range(3)] + [("http://h/b/1", other)]
    found = _texts(spark, pages)
    assert [found[k] for k in range(3)] == ["The story of a river and its many long bends"] * 3
    assert found[3] == "A quite different report on the price of bread"


def test_near_copies_keep_their_article(spark):
    article = ["The story of a river and its many long bends", "It rises in the hills and ends in the sea"]
    pages = [("http://h/1", _page("3 May", *article)), ("http://h/2", _page("4 May", *article))]
    found = _texts(spark, pages)
    assert found[0] == "\n".join(["3 May", *article]) and found[1] == "\n".join(["4 May", *article])


def test_near_copies_are_aligned_with_another_body(spark):
    article = [f"The story of a river, its bends and bridges, part {k}" for k in range(4)]
    copies = [(f"http://h/a/{k:03}", _page(*TEMPLATE, f"{k} May", *article)) for k in range(30)]
    other = [("http://h/b", _page(*TEMPLATE, "A quite different report on the price of bread and of salt"))]
    found = _texts(spark, copies + other)
    for k in range(30):
        assert found[k] == "\n".join([f"{k} May", *article])
    assert found[30] == "A quite different report on the price of bread and of salt"


def _plain(pages, names):
    """Texts of unmarked pages: grouped, ordered, cut into runs and aligned one after the other."""
    known = []
    for url, lines in pages:
        host, path = html_extract.host_and_path(url)
        codes = html_extract._codes(lines)
        known.append((host, path, html_extract._lines_key(codes), tuple(codes.tolist()), lines))
    shared = {}
    for host, own in groupby(sorted(known, key=lambda page: page[0]), key=lambda page: page[0]):
        if not host:
            continue
        bodies = {}
        for _, path, key, codes, lines in own:
            if codes:
                first = bodies.get(key)
                bodies[key] = (min(path, first[0]) if first else path, codes, lines)
        row = sorted((path, key, codes, lines) for key, (path, codes, lines) in bodies.items())
        runs = []
        for page in row:
            last = runs[-1][-1] if runs else None
            if last and html_extract.same_body(
                list(last[2]), list(page[2]), [html_extract.prose(x) for x in last[3]], [html_extract.prose(x) for x in page[3]]
            ):
                runs[-1].append(page)
            else:
                runs.append([page])
        for k, run in enumerate(runs):
            beside = ([(1, runs[k - 1][-1])] if k else []) + ([(0, runs[k + 1][0])] if k + 1 < len(runs) else [])
            for path, key, codes, _ in run:
                best = max(
                    (2 * html_extract._near(path, other[0]) + before, other[2]) for before, other in beside
                ) if beside else None
                if best:
                    matched = [i for i, _ in html_extract.common_subsequence(list(codes), list(best[1]))]
                    shared[host, key] = set(matched) if len(matched) < len(codes) else set()
    return {
        k: "\n".join(line for i, line in enumerate(lines) if i not in shared.get((host, key), ()))
        for k, (host, _, key, _, lines) in enumerate(known)
    }


@pytest.mark.parametrize("block", [4096, 3])
def test_hosts_against_a_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(html_extract, "_BLOCK", block)
    random_ = random.Random(5)
    words = [f"word{k}" for k in range(300)]
    pages = []
    for host in ("one", "two", "three", "four", ""):
        template = [" ".join(random_.choices(words, k=3)) for _ in range(random_.randrange(5))]
        bodies = [[" ".join(random_.choices(words, k=random_.randrange(1, 30))) for _ in range(random_.randrange(6))]
                  for _ in range(5)]
        for k in range(random_.randrange(1, 25)):
            body = list(random_.choice(bodies))
            if body and random_.random() < 0.5:
                body[random_.randrange(len(body))] = f"line of page {k}"
            url = f"http://{host}/{random_.choice('abc')}/{random_.randrange(10**6)}" if host else f"page{k}"
            lines = template[:2] + body + template[2:]
            pages += [(url, lines)] * random_.choice([1, 1, 1, 3])
    found = _texts(spark, [(url, _page(*lines)) for url, lines in pages])
    assert found == _plain(pages, words)


def test_only_lines_that_may_be_main_text_travel(spark):
    lines = ["Home", "Read more", "A river", "Links", "Copyright"]
    marks = bytes([0, 1 | 1 << 3, 1, 1 | 1 << 2, 0])  # the middle three in an article, one of them furniture
    assert html_extract.candidates(lines, marks) == (["Read more", "A river"], [1, -1])
    assert html_extract.main_text(["Read more", "A river"], [1, -1], {1, 2}) == "A river"
    assert html_extract.candidates(["a", "b"], bytes([0, 1 << 2])) == (["a"], [0])
    assert html_extract.candidates([], b"") == ([], [])


def test_texts_meet_shared_lines_by_one_plan_for_all_sizes(spark):
    pages = spark.createDataFrame(
        [(k, f"http://h/{k}", _page(*TEMPLATE, f"story {k}")) for k in range(3)],
        "page_id bigint, url string, html string")
    plan = html_extract.extract_text(pages)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
