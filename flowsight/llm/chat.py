"""Chat formatting that is checked by reading it back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.llm.batches import arrow_schema, map_batches, required, text_or_empty

ESCAPE = "\\"


class Grammar:
    """A template: each known role has an opening and a closing mark, any other role is named in a header.

    ``turn := open text close | header name header_end text footer``. Within names and texts the
    escape character makes the next character literal. All marks begin with characters that no other
    mark has inside, so the next unescaped mark is found from left to right in one way only.
    """

    def __init__(self, roles: dict[str, tuple[str, str]], header: str, header_end: str, footer: str, trained: str):
        self.roles, self.header, self.header_end, self.footer = roles, header, header_end, footer
        self.trained = trained
        self.marks = [header, header_end, footer, *(mark for pair in roles.values() for mark in pair)]
        self.opening = {opened: (role, closed) for role, (opened, closed) in roles.items()}
        either = "|".join(map(re.escape, sorted(self.marks, key=len, reverse=True)))
        self.token = re.compile(rf"{re.escape(ESCAPE)}(?s:.)|{either}")
        self.conflict = re.compile(f"{re.escape(ESCAPE)}|{either}")
        self.firsts = re.compile("[" + re.escape(ESCAPE + "".join({mark[0] for mark in self.marks})) + "]")

    def escaped(self, text: str, level: int) -> str:
        """Level 0 is the text; 1 escapes what reads as a mark or an escape; 2 every character that could begin one."""
        if level == 0:
            return text
        return (self.conflict if level == 1 else self.firsts).sub(lambda found: ESCAPE + found[0], text)

    def render(self, role: str, text: str, level: int) -> tuple[str, int, int]:
        """A turn, and where its text begins and ends in it."""
        opened, closed = self.roles.get(role, (None, self.footer))
        if opened is None:
            opened = self.header + self.escaped(role, level) + self.header_end
        body = self.escaped(text, level)
        return opened + body + closed, len(opened), len(opened) + len(body)

    def read(self, text: str, start: int, closed: str) -> tuple[str, int, int] | None:
        """Unescaped content from ``start`` to the mark ``closed``, and where the mark begins and ends."""
        parts, at = [], start
        while found := self.token.search(text, at):
            parts.append(text[at : found.start()])
            if found[0] == closed:
                return "".join(parts), found.start(), found.end()
            if found[0][0] != ESCAPE:
                return None
            parts.append(found[0][1])
            at = found.end()
        return None

    def turn_at(self, text: str, start: int) -> tuple[str, str, tuple[int, int], int] | None:
        """Role, content, span of the text and end of the turn at ``start``; None if no whole turn is there."""
        found = self.token.match(text, start)
        if not found:
            return None
        if found[0] == self.header:
            name = self.read(text, found.end(), self.header_end)
            if name is None:
                return None
            role, at, closed = name[0], name[2], self.footer
        elif found[0] in self.opening:
            (role, closed), at = self.opening[found[0]], found.end()
        else:
            return None
        content = self.read(text, at, closed)
        return content and (role, content[0], (at, content[1]), content[2])

    def settle(self, role: str, text: str) -> tuple[str, int, int]:
        """The turn with as little escaping as reads back to the same role, text and span."""
        for level in (0, 1, 2):
            turn, start, end = self.render(role, text, level)
            if self.turn_at(turn, 0) == (role, text, (start, end), len(turn)):
                return turn, start, end
        raise ValueError(f"a turn of role {role[:50]!r} cannot be read back")


# The marks of the template.
INSTRUCT = Grammar(
    {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")},
    "[ROLE]", "[/ROLE]", "[/TURN]", "assistant",
)

TURNS = "conv_id bigint, turn bigint, role string, text string"
FORMATTED = "conv_id bigint, turn bigint, role string, text string, formatted string, loss_start bigint, loss_end bigint"


def format_turns(turns: DataFrame, grammar: Grammar = INSTRUCT) -> DataFrame:
    """``FORMATTED``: every turn as it stands in its conversation's text, and the span of it that is trained on.

    Each turn is written, read back and compared; content that does not come back the same is
    escaped. The spans of roles that are not trained on are null. A null role or text counts as
    empty. Turns are independent, so nothing is shuffled; an empty table gives an empty result.
    """

    def convert(columns):
        ids, numbers, roles, texts = columns
        done = [grammar.settle(role, text) for role, text in zip(roles, texts)]
        trained = [role == grammar.trained for role in roles]
        return {
            "conv_id": ids, "turn": numbers, "role": roles, "text": texts,
            "formatted": [turn for turn, _, _ in done],
            "loss_start": [start if yes else None for (_, start, _), yes in zip(done, trained)],
            "loss_end": [end if yes else None for (_, _, end), yes in zip(done, trained)],
        }

    chosen = required(turns, "conv_id", "turn", "role", "text")
    ready = chosen.select(
        chosen["conv_id"].cast("bigint"), chosen["turn"].cast("bigint"),
        text_or_empty(chosen, "role").alias("role"), text_or_empty(chosen, "text").alias("text"),
    )
    return map_batches(ready, FORMATTED, convert)


def in_order(formatted: DataFrame) -> DataFrame:
    """Each conversation's pieces one after another in one task; ties of turns by role, then text."""
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


class Reader:
    """Reads one conversation's text as it comes and keeps digests only."""

    def __init__(self, grammar: Grammar, conv_id):
        self.grammar, self.conv_id = grammar, conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.rest = ""

    def feed(self, piece: str) -> None:
        self.chars += len(piece)
        text, at = self.rest + piece, 0
        while at < len(text) and (found := self.grammar.turn_at(text, at)):
            role, content, _, at = found
            self.n_turns += 1
            self.turns.update(f"{role}\n{content}\n".encode())
            if role == self.grammar.trained:
                self.loss_chars += len(content)
                self.loss.update(content.encode())
        self.rest = text[at:]

    def row(self) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {self.conv_id} cannot be read back")
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ_BACK = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def read_back(formatted: DataFrame, grammar: Grammar = INSTRUCT) -> DataFrame:
    """``READ_BACK`` of every conversation, from the formatted text alone.

    A conversation's text is streamed through one parser turn by turn, so a very long one takes time
    in its task, whose digest is sequential by nature, but no memory. Rows without a conv_id are one
    conversation; a repeated row is a turn of its own.
    """
    schema = arrow_schema(READ_BACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            rows = []
            for conv_id, piece in zip(*(column.to_pylist() for column in batch.columns)):
                if reader is None or reader.conv_id != conv_id:
                    if reader:
                        rows.append(reader.row())
                    reader = Reader(grammar, conv_id)
                reader.feed(piece)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema=schema)
        if reader:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, reader.row()))], schema=schema)

    return in_order(formatted).select("conv_id", "formatted").mapInArrow(run, READ_BACK)


def conversation_texts(formatted: DataFrame) -> DataFrame:
    """``conv_id, text, loss_spans`` with one row a conversation, for users whose conversations fit a row.

    The spans are starts and ends in the text. ``read_back`` and ``format_turns`` have no such limit.
    """
    size = F.length("formatted").cast("bigint")
    pieces = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "formatted", "loss_start", "loss_end", size.alias("size"))))
    start = F.aggregate(
        "pieces",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda state, piece: F.struct(
            (state["at"] + piece["size"]).alias("at"),
            F.when(
                piece["loss_start"].isNotNull(),
                F.array_append(
                    state["spans"],
                    F.struct((state["at"] + piece["loss_start"]).alias("start"), (state["at"] + piece["loss_end"]).alias("end")),
                ),
            ).otherwise(state["spans"]).alias("spans"),
        ),
    )
    return formatted.groupBy("conv_id").agg(pieces.alias("pieces")).select(
        "conv_id", F.array_join(F.col("pieces.formatted"), "").alias("text"), start["spans"].alias("loss_spans")
    )
