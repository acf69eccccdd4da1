"""Repair of the structure of conversations by the cheapest edits.

A repaired conversation is empty, or a system turn at most and then user and assistant turns
in alternation. The turns of a damaged one are kept, given another role or deleted, and empty
turns are inserted; the audit, one letter an edit, names the cheapest way, the ASCII-least of
several.

The audits of a dynamic program share their beginnings: each is a linked node with ancestors
at the distances 1, 2, 4, ... and a rolling hash of all letters up to it. Two audits of the
same cost are compared at their first different letter, which is searched over the ancestors;
where equal hashes are taken for equal letters, the letters are compared as well.

Long conversations are cut. Turns are numbered in order over the whole table, and every block
of numbers is worked on by itself, from each state the turns before it may have left. What a
block has to tell the others is of fixed size: the costs between states, and how the audits
compare. Audits of the same turns are never the beginning of each other but for inserts at
their end, so that comparing block by block is exact.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom.llm.frames import column
from transitloom.operators.ordering import with_rank
from transitloom.operators.skew import skew_join
from transitloom.storage import materialize

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
SOUND, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
FAULTS = (None, "blank", "duplicate", "truncated")
ROLES = {"u": "user", "a": "assistant"}
BLOCK_TURNS = 4096
_REROLE_COST, _DELETE_COST, _INSERT_COST, _TRUNCATED_COST = 3, 4, 3, 3
#: By state (nothing yet, after system, after user, after assistant) and role: the next state.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_STATES = range(4)
_ENDS = (0, 3)
_MODULUS, _BASE = (1 << 61) - 1, 1_000_003
_LESS, _MORE = -1000, 1000  # how audits compare; a number between: so many inserts longer
_SHIFTS = range(3)  # no cheapest audit has three inserts in a row


class Audits:
    """Sequences of letters that share their beginnings; node 0 is the empty one."""

    def __init__(self):
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.ancestors: list[list[int]] = [[]]
        self.verified: set[tuple[int, int]] = set()

    def add(self, node: int, letter: str) -> int:
        """The audit of ``node`` with one more letter."""
        ancestors, step = [node], 0
        while len(self.ancestors[ancestors[step]]) > step:
            ancestors.append(self.ancestors[ancestors[step]][step])
            step += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % _MODULUS)
        self.ancestors.append(ancestors)
        return len(self.letter) - 1

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.ancestors[node][0]
        return "".join(reversed(letters))

    def _at(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.ancestors[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether nodes of equal hash and depth are the same letters."""
        passed = []
        while a != b and (a, b) not in self.verified:
            if self.letter[a] != self.letter[b]:
                return False
            passed.append((a, b))
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        self.verified.update(passed[:1])
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the audit ``a`` comes before ``b`` in ASCII order."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._at(a, depth), self._at(b, depth)
        if self.hash[x] == self.hash[y]:
            return self.depth[a] < self.depth[b] if self._same(x, y) else self.text(a) < self.text(b)
        for step in range(depth.bit_length() - 1, -1, -1):
            if step < len(self.ancestors[x]):
                up, vp = self.ancestors[x][step], self.ancestors[y][step]
                if self.hash[up] != self.hash[vp]:
                    x, y = up, vp
        # The parents have the same hash: the first different letters are these.
        if self._same(self.ancestors[x][0], self.ancestors[y][0]):
            return self.letter[x] < self.letter[y]
        return self.text(a) < self.text(b)


def _offer(audits: Audits, best: list, state: int, cost: int, node: int, letter: str) -> None:
    held = best[state]
    if held is None or cost < held[0]:
        best[state] = (cost, audits.add(node, letter))
    elif cost == held[0]:
        found = audits.add(node, letter)
        if audits.less(found, held[1]):
            best[state] = (cost, found)


def _insert(audits: Audits, best: list) -> None:
    """Inserted turns where they make a state cheaper; two in a row reach every state."""
    before = list(best)
    for state in (0, 1, 3):
        if before[state]:
            _offer(audits, best, 2, before[state][0] + _INSERT_COST, before[state][1], INSERT)
    if best[2]:
        _offer(audits, best, 3, best[2][0] + _INSERT_COST, best[2][1], INSERT)


def cheapest_audits(
    turns: list[tuple[str, int]], start: int = 0
) -> list[tuple[int, str] | None]:
    """``(cost, audit)`` by the state after ``turns`` of (role initial, fault), from ``start``."""
    audits = Audits()
    best: list = [None] * 4
    best[start] = (0, 0)
    for initial, fault in turns:
        _insert(audits, best)
        after: list = [None] * 4
        extra = _TRUNCATED_COST if fault == TRUNCATED else 0
        for state in _STATES:
            if best[state] is None:
                continue
            cost, node = best[state]
            if fault not in (BLANK, DUPLICATE):
                if initial in _NEXT[state]:
                    _offer(audits, after, _NEXT[state][initial], cost + extra, node, KEEP)
                for role in ROLES:
                    if role in _NEXT[state]:
                        _offer(audits, after, _NEXT[state][role], cost + extra + _REROLE_COST, node, REROLE)
            _offer(audits, after, state, cost + _DELETE_COST, node, DELETE)
        best = after
    _insert(audits, best)
    return [held and (held[0], audits.text(held[1])) for held in best]


def _ended(found: list[tuple[int, str] | None]) -> tuple[int, str]:
    return min(found[state] for state in _ENDS if found[state])


def _comparison(audits: list[str | None]) -> dict[str, list[int]]:
    """How the audits of a block, behind 0 to 2 inserts, compare: the place of each, what it is
    without the inserts at its end, and their number."""
    shifted = [None if text is None else INSERT * k + text for k in _SHIFTS for text in audits]
    given = sorted({text for text in shifted if text is not None})
    stems = sorted({text.rstrip(INSERT) for text in given})
    place = {text: at for at, text in enumerate(given)}
    number = {text: at for at, text in enumerate(stems)}
    return {
        "places": [-1 if text is None else place[text] for text in shifted],
        "stems": [-1 if text is None else number[text.rstrip(INSERT)] for text in shifted],
        "tails": [0 if text is None else len(text) - len(text.rstrip(INSERT)) for text in shifted],
    }


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


_SEGMENT = (
    "talk string, block bigint, first_rank bigint, faults string, initials array<string>, "
    "illegal bigint, cost bigint, audit string, costs array<bigint>, audits array<string>, "
    "places array<int>, stems array<int>, tails array<int>"
)


def _segment(talk, block, rows, opens: bool, closes: bool) -> dict:
    """What a block makes of its turns of one conversation; final where none lie outside it."""
    turns = [(initial, fault) for _, _, initial, fault in rows]
    initials = [initial for initial, _ in turns]
    found = {
        "talk": talk, "block": block, "first_rank": rows[0][1],
        "faults": "".join(str(fault) for _, fault in turns),
        "initials": initials, "illegal": _illegal(initials),
        "cost": None, "audit": None, "costs": None, "audits": None,
        "places": None, "stems": None, "tails": None,
    }
    if opens and closes:
        found["cost"], found["audit"] = _ended(cheapest_audits(turns))
        return found
    starts = (0,) if opens else _STATES
    table = [
        held
        for start in _STATES
        for held in (cheapest_audits(turns, start) if start in starts else [None] * 4)
    ]
    texts = [held and held[1] for held in table]
    found |= {"costs": [held and held[0] for held in table], "audits": texts, **_comparison(texts)}
    return found


def _work_on_blocks(batches):
    """Turns sorted by rank to segments; the first and the last conversation of a block may go on
    in the blocks beside it."""
    block, rows = None, []

    def finished():
        talks = [(talk, list(own)) for talk, own in groupby(rows, key=lambda row: row[0])]
        last = len(talks) - 1
        return pa.RecordBatch.from_pylist(
            [
                _segment(talk, block, own, opens=at > 0, closes=at < last)
                for at, (talk, own) in enumerate(talks)
            ],
            schema=_arrow(_SEGMENT),
        )

    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("block", "talk", "rank", "initial", "fault")), strict=True):
            if row[0] != block:
                if rows:
                    yield finished()
                block, rows = row[0], []
            rows.append(row[1:])
    if rows:
        yield finished()


def _arrow(ddl: str) -> pa.Schema:
    kinds = {
        "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(),
        "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
        "array<int>": pa.list_(pa.int32()),
    }
    named = [field.split(" ") for field in ddl.split(", ")]
    return pa.schema([(name, kinds[kind]) for name, kind in named])


class _Fold:
    """The cheapest way through the segments of one conversation, kept by state only."""

    def __init__(self):
        self.segments: list[tuple] = []  # block, illegal with the seam, and by state: where from
        self.costs: list = [0, None, None, None]
        self.relation = [[0] * 4 for _ in _STATES]
        self.last = None

    @staticmethod
    def _compare(segment, shift_a: int, a: int, shift_b: int, b: int) -> int:
        x, y = 16 * shift_a + a, 16 * shift_b + b
        if segment["stems"][x] == segment["stems"][y]:
            return segment["tails"][x] - segment["tails"][y]
        return _LESS if segment["places"][x] < segment["places"][y] else _MORE

    def _joined(self, segment, from_a: int, to_a: int, from_b: int, to_b: int) -> int:
        """How the ways by ``from_a`` to ``to_a`` and by ``from_b`` to ``to_b`` compare."""
        known = self.relation[from_a][from_b]
        if known in (_LESS, _MORE):
            return known
        a, b = 4 * from_a + to_a, 4 * from_b + to_b
        return self._compare(segment, max(known, 0), a, max(-known, 0), b)

    def add(self, segment: dict) -> None:
        costs, origin = [None] * 4, [None] * 4
        for state in _STATES:
            for before in _STATES:
                own = segment["costs"][4 * before + state]
                if own is None or self.costs[before] is None:
                    continue
                cost = self.costs[before] + own
                held = costs[state]
                if held is None or cost < held or (
                    cost == held and self._joined(segment, before, state, origin[state], state) < 0
                ):
                    costs[state], origin[state] = cost, before
        self.relation = [
            [
                0 if costs[a] is None or costs[b] is None
                else self._joined(segment, origin[a], a, origin[b], b)
                for b in _STATES
            ]
            for a in _STATES
        ]
        seam = 0 if self.last is None else _illegal([self.last, segment["head"]])
        self.segments.append((segment["block"], segment["illegal"] + seam, origin))
        self.costs, self.last = costs, segment["last"]

    def choices(self):
        """``(block, illegal, chosen entry)`` of every segment."""
        empty, full = _ENDS
        state = empty
        if self.costs[full] is not None and (
            self.costs[full] < self.costs[empty]
            or (self.costs[full] == self.costs[empty] and self.relation[full][empty] < 0)
        ):
            state = full
        for block, illegal, origin in reversed(self.segments):
            yield block, illegal, 4 * origin[state] + state
            state = origin[state]


_CHOICE = "talk string, block bigint, whole_illegal bigint, entry int"


def _choose(batches):
    """Segments sorted by conversation and block to the entry that each one contributes."""
    fold, talk = None, None

    def finished():
        made = [
            {"talk": talk, "block": block, "whole_illegal": illegal, "entry": entry}
            for block, illegal, entry in fold.choices()
        ]
        return pa.RecordBatch.from_pylist(made, schema=_arrow(_CHOICE))

    for batch in batches:
        for segment in batch.to_pylist():
            if fold is None or segment["talk"] != talk:
                if fold is not None:
                    yield finished()
                fold, talk = _Fold(), segment["talk"]
            fold.add(segment)
    if fold is not None:
        yield finished()


_EDIT = (
    "talk string, block bigint, place int, edit string, rank bigint, given string, fault int"
)


def _edits(batches):
    """Chosen audits letter by letter, with the turn's rank or the role of an inserted one.

    The role to give follows from the edits before: a segment starts with the state it was
    chosen for.
    """
    for batch in batches:
        made = []
        for one in batch.to_pylist():
            state, at = one["start"], 0
            for place, edit in enumerate(one["audit"]):
                rank = given = fault = None
                if edit != INSERT:
                    rank, fault = one["first_rank"] + at, int(one["faults"][at])
                    initial = one["initials"][at]
                    at += 1
                if edit in (INSERT, REROLE):
                    initial = "a" if state == 2 else "u"
                    given = ROLES[initial]
                if edit != DELETE:
                    state = _NEXT[state][initial]
                made.append((one["talk"], one["block"], place, edit, rank, given, fault))
        schema = _arrow(_EDIT)
        columns = list(zip(*made, strict=True)) if made else [()] * len(schema)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)],
            schema=schema,
        )


@dataclass(frozen=True)
class RepairedConversations:
    """``edits``: one row an edit, ``conv_id, talk`` (the same as a text), ``block, place`` (the
    order of edits), ``edit, fault, turn, role, text`` (repaired, or as they were where deleted).
    ``reports``: one row a conversation, ``conv_id, talk, n_turns, gaps, blank, duplicate,
    truncated, illegal, cost, audit``."""

    edits: DataFrame
    reports: DataFrame


def repair(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block_turns: int = BLOCK_TURNS,
) -> RepairedConversations:
    """The cheapest repair of every conversation.

    Keeping a turn costs 0, giving it the role user or assistant 3, deleting it 4, inserting an
    empty one 3; a truncated turn that stays adds 3. Blank turns and turns whose role and text
    the conversation had before are deleted. A turn's first fault counts. ``gaps`` is how many
    numbers between the smallest and the largest turn are not there, ``illegal`` how many
    adjacent turns have role initials other than su, ua, au.

    * Null roles and texts count as one space (so such a text is blank). Null turns come first
      and have no part in ``gaps``; null conversations are one.
    * Turns of equal number are ordered by role and by the text's SHA-256; repeated rows stay
      and are duplicates. Extra columns are ignored, whatever their names.
    * An empty table gives no edits and no reports. Texts are only moved, never held together;
      the audit of a conversation is one value, a letter or so for each of its turns.
    """
    rows = conversations.select(
        _talk(conv_col),
        column(turn_col).alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.sha2("text", 256))
    # Stored with their texts in order; from here on ranks stand for turns.
    ranked = materialize(with_rank(rows, ["talk", "turn", "role", "digest"]), "turns")

    kind = ["talk", "role", "digest"]
    repeated = ranked.groupBy(*kind).agg(F.min("rank").alias("original"), F.count("*").alias("n"))
    repeated = materialize(repeated.where("n > 1").drop("n"), "repeated")
    ending = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    judged = ranked.select(*kind, "rank", F.left("role", F.lit(1)).alias("initial"), ending.alias("ending"))
    judged = skew_join(judged, repeated, kind, "left", unique_right=True)
    fault = (
        F.when(F.col("ending") == "", BLANK)
        .when(F.col("rank") > F.col("original"), DUPLICATE)
        .when(~F.col("ending").isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )
    judged = judged.select(
        F.floor(F.col("rank") / block_turns).alias("block"), "talk", "rank", "initial", fault.alias("fault")
    )
    judged = materialize(judged, "judged")
    sorted_blocks = judged.repartition("block").sortWithinPartitions("rank")
    segments = materialize(sorted_blocks.mapInArrow(_work_on_blocks, _SEGMENT), "segments")

    whole = segments.where("audit IS NOT NULL")
    parts = segments.where("audit IS NULL")
    told = parts.select(
        "talk", "block", F.get("initials", F.lit(0)).alias("head"),
        F.element_at("initials", -1).alias("last"), "illegal", "costs", "places", "stems", "tails",
    )
    chosen = told.repartition("talk").sortWithinPartitions("talk", "block").mapInArrow(_choose, _CHOICE)
    taken = parts.join(chosen, ["talk", "block"]).select(
        "talk", "block", "first_rank", "faults", "initials", F.col("whole_illegal").alias("illegal"),
        F.get("costs", "entry").alias("cost"), F.get("audits", "entry").alias("audit"),
        F.floor(F.col("entry") / 4).cast("int").alias("start"),
    )
    final = whole.select(*taken.columns[:-1], F.lit(0).alias("start")).unionByName(taken)
    final = materialize(final, "audits")

    edits = final.mapInArrow(_edits, _EDIT)
    made = _with_texts(edits, ranked, conversations.schema[conv_col].dataType)

    spelled = F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda part: part["audit"])

    def number_of(code):
        return F.sum(F.length("faults") - F.length(F.replace("faults", F.lit(str(code)), F.lit(""))))

    sums = final.groupBy("talk").agg(
        F.sum(F.length("faults")).alias("n_turns"),
        *[number_of(code).alias(FAULTS[code]) for code in (BLANK, DUPLICATE, TRUNCATED)],
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(spelled, "").alias("audit"),
    )
    turns = ranked.select("talk", "turn").distinct()
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    spans = turns.groupBy("talk").agg(gaps.cast("bigint").alias("gaps"))
    reports = spans.join(sums, "talk").select(
        _conversation(conversations.schema[conv_col].dataType), "talk", "n_turns", "gaps", "blank",
        "duplicate", "truncated", "illegal", "cost", "audit",
    )
    return RepairedConversations(made, reports)


def _talk(conv_col: str):
    """The conversation as a text, null as well."""
    return F.coalesce(F.concat(F.lit("c"), column(conv_col).cast("string")), F.lit("null")).alias("talk")


def _conversation(kind: T.DataType):
    return F.when(F.col("talk") != "null", F.expr("substring(talk, 2)")).cast(kind).alias("conv_id")


def _with_texts(edits: DataFrame, ranked: DataFrame, kind: T.DataType) -> DataFrame:
    """Edits with the turns they are about; inserts have none, and take no part in the join."""
    about = edits.where("rank IS NOT NULL").join(ranked.select("rank", "turn", "role", "text"), "rank")
    about = about.withColumn("role", F.coalesce("given", "role"))
    added = edits.where("rank IS NULL").withColumns(
        {"turn": F.lit(None).cast(ranked.schema["turn"].dataType), "role": F.col("given"), "text": F.lit("")}
    )
    named = F.get(F.array(*[F.lit(name) for name in FAULTS]), F.col("fault"))
    columns = [
        _conversation(kind), "talk", "block", "place", "edit", named.alias("fault"), "turn", "role", "text",
    ]
    return about.select(*columns).unionByName(added.select(*columns))


def repaired_turns(repaired: RepairedConversations) -> DataFrame:
    """The turns that a repaired conversation consists of, as ``conv_id, turn, role, text`` with
    new turn numbers from 0.

    An empty table gives no rows; a conversation whose turns all go has none. A conversation's
    turns are numbered in one task, without their texts being held.
    """
    left = repaired.edits.where(F.col("edit") != DELETE)
    ordered = left.repartition("talk").sortWithinPartitions("talk", "block", "place")
    schema = T.StructType(
        [left.schema["conv_id"], T.StructField("turn", T.LongType()), left.schema["role"], left.schema["text"]]
    )

    def number(batches):
        talk, turn = None, 0
        for batch in batches:
            turns = []
            for name in batch.column("talk").to_pylist():
                talk, turn = (talk, turn + 1) if name == talk else (name, 0)
                turns.append(turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(turns, pa.int64()), batch.column("role"), batch.column("text")],
                names=schema.names,
            )

    return ordered.mapInArrow(number, schema)


def text_digests(repaired: RepairedConversations) -> DataFrame:
    """``talk, repaired_sha256``: the digest of the repaired ``role:text``, joined by line ends.

    The turns of a conversation come sorted to one task, one at a time; its memory does not grow
    with the conversation, and a digest needs its order. Conversations left without turns, and
    an empty table, have no row.
    """
    left = repaired.edits.where(F.col("edit") != DELETE)
    ordered = left.repartition("talk").sortWithinPartitions("talk", "block", "place")
    ordered = ordered.select("talk", F.concat("role", F.lit(":"), "text").alias("line"))

    def digest(batches):
        talk, running = None, None
        for batch in batches:
            done = []
            for name, line in zip(batch.column("talk").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if running is not None and name == talk:
                    running.update(b"\n")
                else:
                    if running is not None:
                        done.append((talk, running.hexdigest()))
                    talk, running = name, hashlib.sha256()
                running.update(line.encode())
            yield _digests(done)
        if running is not None:
            yield _digests([(talk, running.hexdigest())])

    return ordered.mapInArrow(digest, "talk string, repaired_sha256 string")


def _digests(done: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([one[k] for one in done], pa.string()) for k in (0, 1)],
        names=["talk", "repaired_sha256"],
    )


def damage(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, turn, role, text`` with faults dealt by a hash of ``conv_id:turn``, to try the
    repair on. Of twenty cases, 0 drops a row, 1 empties its text, 2 removes ``.``, ``!`` and
    ``?``, 3 repeats it, 4 makes its role user.

    Null roles, texts, and conversations or turns inside the hash count as one space. Repeated
    rows meet the same fate; an empty table stays empty, extra columns go.
    """

    def text_of(name):
        return F.coalesce(column(name).cast("string"), F.lit(" "))

    dealt = conversations.select(
        column(conv_col).alias("conv_id"),
        column(turn_col).alias("turn"),
        text_of(role_col).alias("role"),
        text_of(text_col).alias("text"),
        (F.crc32(F.concat(text_of(conv_col), F.lit(":"), text_of(turn_col))) % 20).alias("_case"),
    ).where("_case > 0")
    case = F.col("_case")
    copies = F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return dealt.select(
        "conv_id", "turn",
        F.when(case == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(case == 1, F.lit("")).when(case == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")
