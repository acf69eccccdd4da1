"""The repair of conversations against all edit sequences and a plain dynamic program."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from tests.conftest import rows
from transitloom.llm import conversation_repair as repair

_LEGAL = re.compile(r"(s?(ua)+)?")
_SPACE = " \t\n\x0b\x0c\r"


def _all_ways(turns):
    """Every (cost, audit) of a few turns of (initial, fault), up to two inserts in each place."""
    inserts = [[(3, "I", role) for role in roles] for n in range(3) for roles in product("ua", repeat=n)]
    found = []
    own = []
    for initial, fault in turns:
        extra = 3 if fault == repair.TRUNCATED else 0
        options = [(4, "D", "")]
        if fault not in (repair.BLANK, repair.DUPLICATE):
            options += [(extra, "K", initial or "-"), (extra + 3, "R", "u"), (extra + 3, "R", "a")]
        own.append(options)
    for added in product(inserts, repeat=len(turns) + 1):
        for edits in product(*own):
            way = list(added[0])
            for edit, more in zip(edits, added[1:], strict=True):
                way += [edit, *more]
            if _LEGAL.fullmatch("".join(role for _, _, role in way)):
                found.append((sum(cost for cost, _, _ in way), "".join(letter for _, letter, _ in way)))
    return min(found)


def _plain(turns):
    """The same by a table of whole texts: (cost, audit, repaired roles)."""
    best = {0: (0, "", ())}

    def insert(best):
        for state, role, to in ((0, "user", 2), (1, "user", 2), (3, "user", 2), (2, "assistant", 3)):
            if state in best:
                cost, audit, made = best[state]
                option = (cost + 3, audit + "I", (*made, (None, role)))
                best[to] = min(best.get(to, option), option)
        return best

    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    for at, (initial, fault) in enumerate(turns):
        after = {}
        extra = 3 if fault == repair.TRUNCATED else 0
        for state, (cost, audit, made) in insert(best).items():
            options = [(state, (cost + 4, audit + "D", made))]
            if fault not in (repair.BLANK, repair.DUPLICATE):
                if (state, initial) in steps:
                    options.append((steps[state, initial], (cost + extra, audit + "K", (*made, (at, None)))))
                for role in ("user", "assistant"):
                    if (state, role[0]) in steps:
                        options.append(
                            (steps[state, role[0]], (cost + extra + 3, audit + "R", (*made, (at, role)))))
            for to, option in options:
                after[to] = min(after.get(to, option), option, key=lambda way: way[:2])
        best = after
    return min((way for state, way in insert(best).items() if state in (0, 3)), key=lambda way: way[:2])


def _turns(random_, n):
    return [(random_.choice(["s", "u", "a", "u", "a", "x", ""]), random_.choice([0, 0, 0, 1, 2, 3, 3])) for _ in range(n)]


def test_dynamic_program_against_all_ways():
    random_ = random.Random(1)
    for _ in range(60):
        turns = _turns(random_, random_.randrange(3))
        assert repair._ended(repair.cheapest_audits(turns)) == _all_ways(turns) == _plain(turns)[:2]


@pytest.mark.parametrize("colliding", [False, True])
def test_shared_audits_against_whole_texts(monkeypatch, colliding):
    if colliding:  # every hash is one of three: letters decide
        monkeypatch.setattr(repair, "_MODULUS", 3)
    random_ = random.Random(2)
    for n in (1, 2, 5, 9, 40, 150):
        for _ in range(20):
            turns = _turns(random_, n)
            assert repair._ended(repair.cheapest_audits(turns)) == _plain(turns)[:2]


def test_blocks_against_one_piece():
    random_ = random.Random(3)
    for _ in range(300):
        turns = _turns(random_, random_.randrange(1, 30))
        fold, texts, at = repair._Fold(), [], 0
        while at < len(turns):
            size = random_.randrange(1, 6)
            rows_ = [("t", at + k, *turn) for k, turn in enumerate(turns[at : at + size])]
            segment = repair._segment("t", at, rows_, opens=False, closes=False)
            segment |= {"head": segment["initials"][0], "last": segment["initials"][-1]}
            fold.add(segment)
            texts.append(segment["audits"])
            at += size
        entries = [(illegal, entry) for _, illegal, entry in reversed(list(fold.choices()))]
        audit = "".join(own[entry] for own, (_, entry) in zip(texts, entries, strict=True))
        assert audit == _plain(turns)[1]
        assert sum(illegal for illegal, _ in entries) == repair._illegal([initial for initial, _ in turns])


def _expected(talk):
    """Report and repaired turns of the rows (turn, role, text) of one conversation."""
    talk = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in talk]
    talk.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], hashlib.sha256(row[2].encode()).hexdigest()))
    seen, turns = set(), []
    for _, role, text in talk:
        shown = text.strip(_SPACE)
        fault = 1 if not shown else 2 if (role, text) in seen else 0 if shown[-1] in ".!?" else 3
        seen.add((role, text))
        turns.append((role[:1], fault))
    cost, audit, made = _plain(turns)
    given = [turn for turn, _, _ in talk if turn is not None]
    gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
    pairs = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:]))
    faults = [fault for _, fault in turns]
    lines = [
        f"{role if role else talk[at][1]}:{'' if at is None else talk[at][2]}" for at, role in made
    ]
    report = (len(talk), gaps, faults.count(1), faults.count(2), faults.count(3), pairs, cost, audit)
    return report, lines


@pytest.fixture(scope="module")
def odd_conversations(spark):
    random_ = random.Random(4)
    texts = ["Yes.", "No", "Yes.", " \n\t", "", None, "What? \r\n", "É!", "…", "word " * 5000 + "end."]
    given = []
    for conv in [*range(12), None]:
        for turn in range(random_.randrange(1, 9) if conv != 5 else 90):
            row = (conv, random_.choice([turn, turn, turn + 3, None]),
                   random_.choice(["user", "assistant", "system", "user", "tool", "", None]),
                   random_.choice(texts) if conv != 5 else f"{turn}" + random_.choice(".?x"), turn, "x")
            given += [row] * random_.choice([1, 1, 1, 2])
    schema = "conv_id bigint, turn bigint, role string, text string, rank int, talk string"
    return spark.createDataFrame(given, schema), given


@pytest.mark.parametrize("block_turns", [4096, 3])
def test_repair_against_brute_force(odd_conversations, block_turns):
    frame, given = odd_conversations
    repaired = repair.repair(frame, block_turns=block_turns)
    found = {row["conv_id"]: tuple(row)[2:] for row in repaired.reports.collect()}
    digests = {row["talk"]: row["repaired_sha256"] for row in repair.text_digests(repaired).collect()}
    turns = rows(repair.repaired_turns(repaired), "conv_id", "turn", "role", "text")
    expected_turns = []
    talks = {row[0] for row in given}
    assert set(found) == talks
    for conv in talks:
        report, lines = _expected([row[1:4] for row in given if row[0] == conv])
        assert found[conv] == report
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert digests.get("null" if conv is None else f"c{conv}", digest) == digest
        expected_turns += [(conv, at, *line.split(":", 1)) for at, line in enumerate(lines)]
    assert turns == sorted(expected_turns, key=repr)


def test_damage(spark):
    frame = spark.createDataFrame(
        [(conv, turn, "assistant", "Well. Yes!?") for conv in (1, 2, 3, None) for turn in [*range(30), None]],
        "conv_id bigint, turn bigint, role string, text string")
    expected = []
    for conv, turn, role, text in map(tuple, frame.collect()):
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        case = zlib.crc32(key.encode()) % 20
        row = (conv, turn, "user" if case == 4 else role,
               "" if case == 1 else "Well Yes" if case == 2 else text)
        expected += [row] * {0: 0, 3: 2}.get(case, 1)
    assert rows(repair.damage(frame)) == sorted(expected, key=repr)


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    repaired = repair.repair(repair.damage(none))
    assert repaired.reports.count() == 0 and repaired.edits.count() == 0
    assert repair.repaired_turns(repaired).count() == 0
    assert repair.text_digests(repaired).count() == 0
