"""Chat formatting with a grammar round trip.

A conversation is ``<s>`` and then its turns: ``<<SYS>>text<</SYS>>``, ``[INST]text[/INST]``, ``[ANS]text</s>``, and
``[TURN]role`` (percent-encoded), a line feed, ``text[/TURN]`` for any other role. Inside a text a control string may not stand as it is: escaped, a
backslash follows its first character, and one that already has n backslashes there gets n + 1; reading takes one away.

Each turn is rendered, parsed again and compared with its source; what conflicts is escaped until both are the same. The loss mask
covers the texts of assistant turns. Turns are rendered where they lie; then each conversation passes sorted through one task as a
stream that holds a single turn, so a conversation of any length fits.

Rows: null texts and roles are empty. Turns are ordered by turn, role and text, nulls first, so ties and repeated rows have one order; a
null conversation id is a conversation of its own. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN = "<s>"
#: role -> what opens and closes its turns
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OTHER = ("[TURN]", "[/TURN]")
CONTROLS = (BEGIN, *(m for marks in (*MARKS.values(), OTHER) for m in marks))
BARE = re.compile("|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True)))
ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in sorted(CONTROLS, key=len, reverse=True)))


class GrammarError(ValueError):
    pass


def escape(text: str, control: str) -> str:
    """The text with one control string, escaped or not, escaped once more."""
    return re.sub(rf"{re.escape(control[0])}(\\*){re.escape(control[1:])}", lambda m: f"{control[0]}\\{m[1]}{control[1:]}", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text) if "\\" in text else text


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its text begins and ends."""
    opening, closing = MARKS.get(role, OTHER)
    head = opening if role in MARKS else f"{opening}{quote(role, safe=' ')}\n"
    return f"{head}{text}{closing}", len(head), len(head) + len(text)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and where the text stands, for each turn. Deterministic: the next control string always decides."""
    at, roles = 0, {opening: (role, closing) for role, (opening, closing) in MARKS.items()}
    if formatted.startswith(BEGIN):
        at = len(BEGIN)
    while at < len(formatted):
        opened = BARE.match(formatted, at)
        if not opened or (opened[0] not in roles and opened[0] != OTHER[0]):
            raise GrammarError(f"no turn opens at {at}")
        closed = BARE.search(formatted, opened.end())
        role, closing = roles.get(opened[0], (None, OTHER[1]))
        if not closed or closed[0] != closing:
            raise GrammarError(f"the turn opened at {at} isn't closed")
        begin = opened.end()
        if role is None:
            line = formatted.find("\n", begin, closed.start())
            if line < 0:
                raise GrammarError(f"the turn opened at {at} has no role")
            role, begin = unquote(formatted[begin:line]), line + 1
        yield role, unescape(formatted[begin : closed.start()]), begin, closed.start()
        at = closed.end()


class Reader:
    """Reads a conversation's formatted text as a whole, but given in parts: a turn comes out once what follows it can no longer change it."""

    def __init__(self) -> None:
        self.text, self.begun = "", False

    def feed(self, part: str) -> Iterator[tuple[str, str]]:
        self.text += part
        while True:
            at = len(BEGIN) if not self.begun and self.text.startswith(BEGIN) else 0
            opened = BARE.match(self.text, at)
            closed = BARE.search(self.text, opened.end()) if opened else None
            if not closed or closed.end() + max(map(len, CONTROLS)) > len(self.text):
                return
            yield from (x[:2] for x in parse(self.text[: closed.end()]))
            self.text, self.begun = self.text[closed.end() :], True

    def close(self) -> Iterator[tuple[str, str]]:
        yield from (x[:2] for x in parse(self.text))


def turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A turn that parses to just this role and text, and where its text begins and ends in it."""
    role, text = role or "", text or ""
    said = text
    for control in ("", *CONTROLS):
        said = escape(said, control) if control else said
        out = rendered(role, said)
        try:
            if [x[:2] for x in parse(out[0])] == [(role, text)]:
                return out
        except GrammarError:
            pass
    raise GrammarError("no escape of the turn reads back")


TURNS = "conv_id bigint, turn bigint, position bigint, formatted string, begins bigint, loss_from bigint, loss_to bigint"


def format_conversations(df: DataFrame, *, conversation: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each turn, a conversation's turns in order in one partition: its place, its part of the formatted text (the first with
    what begins the conversation), where that part begins, and which characters of the conversation its loss mask covers."""
    rows = df.select(F.col(conversation).cast("long").alias("conv_id"), F.col(order).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = batch.column(2).to_pylist()
            made = [turn(*x) for x in zip(roles, batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] if r == "assistant" else None for m, r in zip(made, roles, strict=True)], pa.int64()), pa.array([m[2] if r == "assistant" else None for m, r in zip(made, roles, strict=True)], pa.int64())], ["conv_id", "turn", "role", "text", "formatted", "a", "b"])

    turns = rows.mapInArrow(render, "conv_id bigint, turn bigint, role string, text string, formatted string, a bigint, b bigint")
    turns = turns.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text").drop("role", "text")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, position, begins = object(), 0, 0
        for batch in batches:
            out: list[tuple] = []
            for conv, nth, said, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != last:
                    last, position, begins = conv, 0, 0
                    said = BEGIN + said
                shift = begins + (len(BEGIN) if position == 0 else 0)
                out.append((conv, nth, position, said, begins, None if a is None else a + shift, None if b is None else b + shift))
                position, begins = position + 1, begins + len(said)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds], ["conv_id", "turn", "position", "formatted", "begins", "loss_from", "loss_to"])

    return turns.mapInArrow(placed, TURNS)
