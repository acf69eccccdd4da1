"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>\\n"

Roles and texts hold no control string. A turn is rendered as it is, parsed again and
compared with its source; while that differs, its content is escaped. Escaping puts one more
backslash after the first character of everything that is a control string but for
backslashes there, so it is undone by taking one away, and twice escaped is twice undone.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom.llm.frames import column

# The control strings, the template's own two first.
CONTROL_STRINGS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
START, END = CONTROL_STRINGS[:2]

_CONTROL = re.compile("|".join(re.escape(string) for string in CONTROL_STRINGS))
_LIKE_CONTROL = re.compile(
    "|".join(f"{re.escape(s[0])}\\\\*{re.escape(s[1:])}" for s in CONTROL_STRINGS)
)
_ESCAPED = re.compile(
    "|".join(f"{re.escape(s[0])}\\\\+{re.escape(s[1:])}" for s in CONTROL_STRINGS)
)
_ROLE_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


class GrammarError(ValueError):
    """The text is not a conversation of the grammar."""


def escaped(content: str) -> str:
    return _LIKE_CONTROL.sub(lambda match: f"{match[0][0]}\\{match[0][1:]}", content)


def unescaped(content: str) -> str:
    return _ESCAPED.sub(lambda match: match[0][0] + match[0][2:], content)


def _role_line(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _role(line: str) -> str:
    return _ROLE_ESCAPE.sub(lambda match: "\n" if match[1] == "n" else match[1], line)


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns ``(role, text)`` of a rendered conversation; deterministic, one pass."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise GrammarError(f"no turn begins at {at}")
        close = _CONTROL.search(rendered, at + len(START))
        if not close or close[0] != END:
            raise GrammarError(f"the turn at {at} has no end of its own")
        role, line_end, text = rendered[at + len(START) : close.start()].partition("\n")
        after = close.end()
        if not line_end or not rendered.startswith("\n", after):
            raise GrammarError(f"the turn at {at} lacks a line end")
        turns.append((_role(unescaped(role)), unescaped(text)))
        at = after + 1
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn, and where its text starts and ends; parses back to the source."""
    for protect in (lambda content: content, escaped):
        head = f"{START}{protect(_role_line(role))}\n"
        body = protect(text)
        rendered = f"{head}{body}{END}\n"
        try:
            if parse(rendered) == [(role, text)]:
                return rendered, len(head), len(head) + len(body)
        except GrammarError:
            pass
    raise GrammarError("no escaping makes the turn parse back to its source")


def format_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """``conv_id, turn, formatted, loss_start, loss_end``: one row per turn.

    ``formatted`` is the turn's part of the conversation; the parts of a conversation, in
    order, are its rendering. ``loss_start`` and ``loss_end`` bound the characters of
    ``formatted`` under the loss mask, null outside ``loss_roles``. Turns are rendered
    where they are: nothing is shuffled, and the longest conversation is no special case.

    * Null roles and texts count as empty, an empty role or text is rendered as such.
    * Null conversations and turns are kept; nulls come first in order. Of equal turn
      numbers the one whose rendering is smaller comes first; repeated rows stay.
    * Extra columns are ignored; an empty table gives no rows.
    """
    rows = conversations.select(
        column(conv_col).alias("conv_id"),
        column(turn_col).alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )

    def render(batches):
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            done = [render_turn(*turn) for turn in zip(roles, texts, strict=True)]
            masked = [role in loss_roles for role in roles]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array([part for part, _, _ in done], pa.string()),
                    pa.array([a if m else None for (_, a, _), m in zip(done, masked, strict=True)], pa.int64()),
                    pa.array([b if m else None for (_, _, b), m in zip(done, masked, strict=True)], pa.int64()),
                ],
                names=["conv_id", "turn", "formatted", "loss_start", "loss_end"],
            )

    kept = [rows.schema["conv_id"], rows.schema["turn"]]
    added = T.StructType.fromDDL("formatted string, loss_start bigint, loss_end bigint").fields
    return rows.mapInArrow(render, T.StructType([*kept, *added]))


def conversation_texts(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted``: whole renderings, for conversations that fit a row.

    Takes what ``format_turns`` returns. Null turns come first, turns of equal number in the
    order of their renderings, repeated rows all of them; null conversations are one. Other
    columns are ignored; an empty table gives no rows.
    """
    parts = F.array_sort(F.collect_list(F.struct("turn", "formatted")))
    return turns.groupBy("conv_id").agg(
        F.array_join(F.transform(parts, lambda part: part["formatted"]), "").alias("formatted")
    )


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation what a reader of ``format_turns`` output finds.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. The turns of
    a conversation come sorted to one task, which parses one at a time and keeps running
    digests: memory does not grow with the conversation, and the digests need its order.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")

    def digest(batches):
        open_one = conv_type = None
        for batch in batches:
            closed = []
            conv_type = batch.schema.field("conv_id").type
            for conv, formatted, start, end in zip(
                *(batch.column(name).to_pylist() for name in ("conv_id", "formatted", "loss_start", "loss_end")),
                strict=True,
            ):
                if open_one is None or open_one[0] != conv:
                    if open_one is not None:
                        closed.append(open_one)
                    open_one = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(formatted):
                    open_one[1] += 1
                    open_one[2].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    under_mask = unescaped(formatted[start:end])
                    open_one[3] += len(under_mask)
                    open_one[4].update(under_mask.encode())
                open_one[5] += len(formatted)
            yield _digested(closed, conv_type)
        if open_one is not None:
            yield _digested([open_one], conv_type)

    fields = T.StructType.fromDDL(
        "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    ).fields
    return ordered.mapInArrow(digest, T.StructType([turns.schema["conv_id"], *fields]))


def _digested(found: list[list], conv_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "conv_id": pa.array([one[0] for one in found], conv_type),
            "n_turns": pa.array([one[1] for one in found], pa.int64()),
            "turns_sha256": pa.array([one[2].hexdigest() for one in found], pa.string()),
            "loss_chars": pa.array([one[3] for one in found], pa.int64()),
            "loss_sha256": pa.array([one[4].hexdigest() for one in found], pa.string()),
            "formatted_chars": pa.array([one[5] for one in found], pa.int64()),
        }
    )
