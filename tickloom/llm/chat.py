"""Chat formatting that is read back before it is kept.

A turn is written as ``### Role: text</turn>`` and a line feed. The grammar: a mark ``### name: `` opens a turn, ``</turn>``
closes it, and inside the text a backslash before another backslash, before ``</turn>`` or before ``### `` makes that sign
or string plain text; any other backslash is itself. A mark inside a text is an error.

Each turn is written plainly first and read back by the parser. If what comes back is not the source, conflicting content is
escaped one step further (marks only, then backslashes too) until it is.

Roles other than system, user and assistant are written as ``=`` and their UTF-8 bytes, percent-encoded; a null role as
``-`` (and hashed as empty). Null text counts as empty. Turns are ordered by turn (null first), then role, then text, and repeated rows are
turns of their own; a null conversation id is a conversation.

Turns are rendered and checked row by row. A conversation's digests run over its turns in order, so one task
streams it through the parser and the hashes; it holds one batch and two hash states, however long the conversation is.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_schema, batch_of

NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
ROLES = {name: role for role, name in NAMES.items()}
CLOSE, OPEN = "</turn>", "### "
_HEAD = re.compile(r"### ([A-Za-z]+|-|=[A-Za-z0-9%_.~-]*): ")
_TOKEN = re.compile(r"\\(?:\\|</turn>|### )|</turn>|### (?:[A-Za-z]+|-|=[A-Za-z0-9%_.~-]*): ")
_MARKS = re.compile(r"</turn>|### ")
_SIGNS = re.compile(r"\\|</turn>|### ")
RENDERED = "conv_id bigint, turn bigint, role string, formatted string, escapes int"
READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


class GrammarError(ValueError):
    pass


def parse(formatted: str) -> list[tuple[str | None, str, int, int]]:
    """(role, text, begin, end) of each turn; begin and end bound the escaped text."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        if not head:
            raise GrammarError(f"no turn opens at {at}")
        name, at = head[1], head.end()
        if name[0] == "=":
            role = unquote(name[1:])
        elif name == "-":
            role = None
        elif name in ROLES:
            role = ROLES[name]
        else:
            raise GrammarError(f"unknown name {name}")
        begin, plain = at, []
        while True:
            token = _TOKEN.search(formatted, at)
            if not token:
                raise GrammarError(f"the turn at {begin} is not closed")
            plain.append(formatted[at : token.start()])
            at = token.end()
            if token[0][0] == "\\":
                plain.append(token[0][1:])
            elif token[0] == CLOSE:
                break
            else:
                raise GrammarError(f"a turn opens inside another at {token.start()}")
        if formatted[at : at + 1] != "\n":
            raise GrammarError(f"no line feed at {at}")
        turns.append((role, "".join(plain), begin, at - len(CLOSE)))
        at += 1
    return turns


def render(role: str | None, text: str) -> tuple[str, int]:
    """A turn as text that the parser reads back as it was, and how far it had to be escaped."""
    name = "-" if role is None else NAMES.get(role, "=" + quote(role, safe=""))
    steps = (lambda t: t, lambda t: _MARKS.sub(r"\\\g<0>", t), lambda t: _SIGNS.sub(r"\\\g<0>", t))
    for level, escape in enumerate(steps):
        out = f"{OPEN}{name}: {escape(text)}{CLOSE}\n"
        try:
            got = parse(out)
        except GrammarError:
            continue
        if [x[:2] for x in got] == [(role, text)]:
            return out, level
    raise AssertionError("a fully escaped turn reads back as it was")


def render_turns(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, formatted, escapes): every row as formatted text."""

    def run(batches):
        for b in batches:
            made = [render(r, t) for r, t in zip(b["role"].to_pylist(), b["text"].to_pylist(), strict=True)]
            columns = [b["conv_id"], b["turn"], b["role"], pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "role", "formatted", "escapes"])

    narrow = df.select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.col(role_col).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return narrow.mapInArrow(run, RENDERED)


class _Reader:
    """Counts and digests of one conversation, fed with its formatted turns in order."""

    def __init__(self, conv):
        self.conv, self.turns, self.size, self.loss = conv, 0, 0, 0
        self.all_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, formatted: str) -> None:
        self.size += len(formatted)
        for role, text, _, _ in parse(formatted):
            self.turns += 1
            self.all_hash.update(f"{role or ''}\n{text}\n".encode())
            if role == "assistant":
                self.loss += len(text)
                self.loss_hash.update(text.encode())

    def row(self):
        return (self.conv, self.turns, self.all_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.size)


def read_back(rendered: DataFrame) -> DataFrame:
    """One row per conversation, parsed from its formatted turns."""
    kind = arrow_schema(READ)

    def run(batches):
        now = None
        for b in batches:
            done = []
            for conv, formatted in zip(b["conv_id"].to_pylist(), b["formatted"].to_pylist(), strict=True):
                if now is None or now.conv != conv:
                    if now:
                        done.append(now.row())
                    now = _Reader(conv)
                now.feed(formatted)
            if done:
                yield batch_of(done, kind)
        if now:
            yield batch_of([now.row()], kind)

    ordered = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.select("conv_id", "formatted").mapInArrow(run, READ)
