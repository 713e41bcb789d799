"""Chat formatting by schema fingerprints.

A record of a conversation comes in one of many layouts. The sorted paths of its non-null fields
(list positions left out) are hashed; that fingerprint selects a declarative mapping, which says
where turns, roles and texts are. Canonical turns are then written by a template and can be read
back from the output exactly.

Template: each turn is ``### Role: <turn> text </turn>`` followed by a line end, see TEMPLATE. In
roles and texts a backslash is doubled and a backslash is put before the template's control
strings, so no text can end a turn or begin one; reading back undoes this. The loss mask is the
list of spans of assistant texts in the output.

Turns are formatted row by row and only then brought together by conversation, sorted by turn;
readers see a conversation as a stream, so one of any length is never held in memory.

A null text is an empty text, a null role an empty role. Rows of one conversation with equal turn
numbers are ordered by role and text. Conversations with a null id form one conversation of their
own. An empty table has no conversations; further columns are ignored, whatever their names. Records of an unknown layout are given out with the
reason, never dropped (they have no turns to digest). Texts of any length are handled whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN_START, ROLE_END, TURN_END = "### ", ": <turn> ", " </turn>\n"
#: Strings that have a meaning in the template.
CONTROL = ("### ", "<turn>", "</turn>")
TEMPLATE = TURN_START + "{role}" + ROLE_END + "{text}" + TURN_END
LEARNED = "assistant"
_MARK = re.compile(r"\\|### |</?turn>")
_UNMARK = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:\\.|[^\\])*?): <turn> ((?:\\.|[^\\])*?) </turn>\n", re.S)


def escape(text: str) -> str:
    return _MARK.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNMARK.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text begins and ends in it."""
    head = TURN_START + escape(role) + ROLE_END
    body = escape(text)
    return head + body + TURN_END, len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts from formatted turns; raises on anything else."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


# --- layouts ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    turns: path of a list of turns, or "" if the record is itself one turn. role and text: paths
    within a turn. fixed: (role, path) pairs for layouts that name a turn's role by its field.
    roles: the layout's own role names and the canonical ones.
    """

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    fixed: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


def field_paths(record, at: str = "") -> set[str]:
    """Paths of all non-null leaves; items of a list share one path."""
    if isinstance(record, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else str(k)) for k, v in record.items()), set())
    if isinstance(record, (list, tuple)):
        return set().union(*(field_paths(v, at + "[]") for v in record), set())
    return set() if record is None else {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


class Mappings:
    """Layouts by fingerprint. `ignored` paths (ids, metadata) don't count towards it."""

    def __init__(self, ignored=("id", "conv_id", "turn", "source", "meta")):
        self.ignored = set(ignored)
        self.known: dict[str, Layout] = {}

    def of(self, record) -> str:
        return fingerprint(p for p in field_paths(record) if p.split(".")[0].removesuffix("[]") not in self.ignored)

    def add(self, layout: Layout, *path_sets) -> Mappings:
        """Registers a layout for each of the given sets of paths."""
        for paths in path_sets:
            self.known[fingerprint(paths)] = layout
        return self

    def turns(self, record) -> list[tuple[str, str]] | None:
        """Canonical (role, text) turns; None for an unknown layout."""
        layout = self.known.get(self.of(record))
        return None if layout is None else apply(layout, record)


def _get(record, path: str):
    for part in path.split(".") if path else ():
        record = record.get(part) if isinstance(record, dict) else None
    return record


def apply(layout: Layout, record) -> list[tuple[str, str]]:
    if layout.fixed:
        return [(role, _get(record, path)) for role, path in layout.fixed if _get(record, path) is not None]
    items = _get(record, layout.turns) if layout.turns else [record]
    names = dict(layout.roles)
    out = []
    for item in items or []:
        role = _get(item, layout.role) or ""
        out.append((names.get(role, role), _get(item, layout.text) or ""))
    return out


_TURN_ROW = Layout("turn rows", role="role", text="text")
_MESSAGES = Layout("messages", turns="messages", role="role", text="content")
_FROM_VALUE = Layout("from and value", turns="conversations", role="from", text="value", roles=(("human", "user"), ("gpt", LEARNED)))
_PROMPT = Layout("prompt and completion", fixed=(("user", "prompt"), (LEARNED, "completion")))
_RESPONSE = Layout("prompt and response", fixed=(("user", "prompt"), (LEARNED, "response")))
_INSTRUCTION = Layout("instruction", fixed=(("system", "system"), ("user", "instruction"), ("user", "input"), (LEARNED, "output")))
DEFAULT = (
    Mappings()
    .add(_TURN_ROW, {"role", "text"}, {"role"}, {"text"}, set())
    .add(_MESSAGES, {"messages[].role", "messages[].content"}, {"messages[].role"})
    .add(_FROM_VALUE, {"conversations[].from", "conversations[].value"})
    .add(_PROMPT, {"prompt", "completion"}, {"prompt"}, {"completion"})
    .add(_RESPONSE, {"prompt", "response"})
    .add(_INSTRUCTION, *({"instruction", "output"} | extra for extra in (set(), {"input"}, {"system"}, {"input", "system"})), {"instruction"}, {"output"})
)


# --- tables -------------------------------------------------------------------------------------

FORMATTED = "conv_id long, turn long, seq int, formatted string, loss_start int, loss_end int, problem string"


def format_records(records: DataFrame, mappings: Mappings = DEFAULT) -> DataFrame:
    """records(conv_id, turn, record): a record is JSON of any registered layout.

    One row per canonical turn: the formatted turn and the span of text under the loss mask in it
    (null for turns that aren't learned). A record of unknown layout or bad JSON gives one row
    without `formatted` and with the problem.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for conv, turn, raw in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    record = json.loads(raw) if raw is not None else {}
                    turns = mappings.turns(record)
                except ValueError:
                    record, turns = None, None
                if turns is None:
                    rows.append((conv, turn, 0, None, None, None, "not JSON" if record is None else f"unknown layout {mappings.of(record)}"))
                    continue
                for k, (role, text) in enumerate(turns):
                    formatted, a, b = format_turn(role, text)
                    learned = role == LEARNED
                    rows.append((conv, turn, k, formatted, a if learned else None, b if learned else None, None))
            columns = list(zip(*rows)) or [[]] * 7
            types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string()]
            names = ["conv_id", "turn", "seq", "formatted", "loss_start", "loss_end", "problem"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return records.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "record").mapInArrow(run, FORMATTED)


def turn_records(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as records, one turn each."""
    return rows.select("conv_id", "turn", F.to_json(F.struct("role", "text")).alias("record"))


def mixed_records(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as records of five layouts, by a hash of the conversation, as corpora of several origins have them.

    A turn whose role a layout can't say stays in the layout of turn_records().
    """
    role, text = F.col("role"), F.coalesce("text", F.lit(""))
    which = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    json_of = lambda *columns: F.to_json(F.struct(*columns))
    messages = json_of(F.array(F.struct(role, text.alias("content"))).alias("messages"))
    speaker = F.when(role == "user", "human").when(role == LEARNED, "gpt").otherwise(role)
    spoken = json_of(F.array(F.struct(speaker.alias("from"), text.alias("value"))).alias("conversations"))
    pair = lambda a, b: F.when(role == "user", json_of(text.alias(a))).when(role == LEARNED, json_of(text.alias(b)))
    special = (
        F.when((which == 1) & role.isNotNull(), messages)
        .when((which == 2) & role.isNotNull() & ~role.isin("human", "gpt"), spoken)
        .when(which == 3, pair("prompt", "completion"))
        .when(which == 4, pair("instruction", "output"))
    )
    return rows.select("conv_id", "turn", F.coalesce(special, json_of("role", "text")).alias("record"))


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted turns: counts and digests of turns and of learned text."""

    def run(batches):
        current, state = object(), None
        for batch in batches:
            done = []
            for conv, formatted, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if state is None or conv != current:
                    if state is not None:
                        done.append(_close(current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if a is not None:
                    learned = unescape(formatted[a:b])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(formatted)
            yield _batch(done)
        if state is not None:
            yield _batch([_close(current, state)])

    rows = formatted.filter("formatted IS NOT NULL").select("conv_id", "formatted", "loss_start", "loss_end", "turn", "seq")
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "seq", "formatted")
        .select("conv_id", "formatted", "loss_start", "loss_end")
        .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    )


def _close(conv, state):
    return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]


def _batch(rows):
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    columns = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
