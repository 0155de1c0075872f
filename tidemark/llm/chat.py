r"""Operator 9: conversations as training text, checked by a grammar round trip.

A turn is ``<|im_start|>role\ntext<|im_end|>\n``; a conversation is its turns in
order. The parser is deterministic: a role ends at the first line feed, a text at
the first ``<|``, which has to begin ``<|im_end|>\n``, and then one backslash is
taken out of every ``<``, backslashes, ``|``. ``<|`` within a role or a text is no
sentence of the grammar, so that rendered text holds no control string but the
template's own marks. A turn is rendered plainly, parsed, and compared with its
source; whatever is refused or does not come back the same is escaped (one more
backslash in those places; in a role also line feeds and backslashes) and tried
again, until it is identical. The grammar needs no context, so this runs on every
turn where it is read, before anything is shuffled.

Turns then meet by conversation and are streamed in order into pieces of at most
``PIECE_CHARS`` (one longer turn is a piece of its own); no conversation is held
whole. ``loss`` has the places of the assistant's texts in a piece.

Rows: null texts and roles count as empty; turns are ordered by turn, role and
text, null turns first; rows that repeat are turns that repeat; a null conv_id is
a conversation of its own; other columns are ignored; no rows give no pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
PIECE_CHARS = 1 << 20

_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Role, text and the text's place in ``rendered`` of each turn; ValueError if it isn't of the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = rendered.index("\n", at)
        stop = rendered.find("<|", line + 1)
        if not rendered.startswith(END, stop) or rendered.find("<|", at + len(START), line) >= 0:
            raise ValueError(f"a control string stands in the turn at {at}")
        turns.append((_unescape_role(rendered[at + len(START):line]), unescape(rendered[line + 1:stop]), line + 1, stop))
        at = stop + len(END)
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn that parses back to ``role`` and ``text``, and the place of the text in it."""
    for shown_role, shown in ((role, text), (role, escape(text)), (_escape_role(role), text), (_escape_role(role), escape(text))):
        rendered = f"{START}{shown_role}\n{shown}{END}"
        try:
            turns = parse(rendered)
        except ValueError:
            continue
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return rendered, *turns[0][2:]
    raise AssertionError("an escaped turn always parses back")


def format_turns(conversations: DataFrame) -> DataFrame:
    """Each turn rendered: conv_id, turn, role, text, rendered, and its text's place [begin, end)."""
    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [render(r, t) for r, t in zip(batch["role"].to_pylist(), batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in out], pa.string()),
                 pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64())],
                names=[*batch.schema.names, "rendered", "begin", "end"])

    turns = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                                 F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
    return turns.mapInArrow(rendered, "conv_id bigint, turn bigint, role string, text string, "
                                      "rendered string, begin bigint, end bigint")


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, piece (from 0), ``formatted`` and ``loss`` ([begin, end) in code points of the piece)."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, number, held, size, loss = None, 0, [], 0, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv_id": conv, "piece": number, "formatted": "".join(held),
                                                "loss": loss}], schema=schema)

        schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("formatted", pa.string()),
                            ("loss", pa.list_(pa.list_(pa.int64())))])
        for batch in batches:
            for c, role, text, a, b in zip(*(batch[n].to_pylist() for n in
                                             ("conv_id", "role", "rendered", "begin", "end"))):
                if held and (c != conv or size + len(text) > PIECE_CHARS):
                    yield row()
                    number, held, size, loss = (number + 1 if c == conv else 0), [], 0, []
                conv = c
                if role == loss_role:
                    loss.append([size + a, size + b])
                held.append(text)
                size += len(text)
        if held:
            yield row()

    return (format_turns(conversations).repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(pieces, "conv_id bigint, piece bigint, formatted string, loss array<array<bigint>>"))


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader recovers from the pieces, one row per conversation.

    Expects the pieces of a conversation in one partition and in order, as
    :func:`format_conversations` leaves them.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row() -> pa.RecordBatch:
            conv, turns, digest, chars, loss, size = state
            return pa.RecordBatch.from_pylist([{
                "conv_id": conv, "n_turns": turns, "turns_sha256": digest.hexdigest(), "loss_chars": chars,
                "loss_sha256": loss.hexdigest(), "formatted_chars": size}], schema=schema)

        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for batch in batches:
            for conv, number, text, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if number == 0:
                    if state:
                        yield row()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, source, _, _ in parse(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{source}\n".encode())
                for a, b in loss:
                    learned = unescape(text[a:b])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
        if state:
            yield row()

    return formatted.select("conv_id", "piece", "formatted", "loss").mapInArrow(
        read, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
              "formatted_chars bigint")
