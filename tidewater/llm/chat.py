"""Chat formatting by schema fingerprints.

A record is a JSON object in any of several layouts. The paths of its nested
fields, sorted and hashed, are its fingerprint, which selects a declarative
mapping: an ordered list of steps, each either one field said by a fixed role or
a list of messages with the names of their role and text fields. Mappings turn
records into canonical turns, and a template into one string with a loss mask
over the assistant's texts.

The template marks turns with control strings. Inside texts, and in roles, each
``<`` that backslashes and a ``|`` follow gets one backslash more, so no control
string survives, and taking one away restores the text exactly.

Defined results. Null or missing texts and roles are empty strings. Null or
broken JSON, or a fingerprint without a mapping: layout null, no turns, an empty
string. Fields that no mapping names do not enter the fingerprint, so extra
fields change nothing. Null ids, repeated records and empty conversations are
formatted like any other. Empty table: no rows. Whole texts, however long.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Say:
    """One field, said by a fixed role; ``optional``: no turn where it is empty."""

    path: str
    role: str
    optional: bool = False


@dataclass(frozen=True)
class Each:
    """A list of messages."""

    path: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()  # roles of the layout -> canonical roles


@dataclass(frozen=True)
class Mapping:
    layout: str
    steps: tuple[Say | Each, ...]

    @property
    def paths(self) -> frozenset[str]:
        out = set()
        for s in self.steps:
            out |= {s.path} if isinstance(s, Say) else {f"{s.path}[].{s.role}", f"{s.path}[].{s.text}"}
        return frozenset(out)


_NAMES = (("human", "user"), ("gpt", ASSISTANT), ("bot", ASSISTANT), ("chatgpt", ASSISTANT))

MAPPINGS = (
    Mapping("messages", (Each("messages", "role", "content"),)),
    Mapping("messages-system", (Say("system", "system"), Each("messages", "role", "content"))),
    Mapping("sharegpt", (Each("conversations", "from", "value", _NAMES),)),
    Mapping("sharegpt-system", (Say("system", "system"), Each("conversations", "from", "value", _NAMES))),
    Mapping("prompt", (Say("prompt", "user"), Say("response", ASSISTANT))),
    Mapping("completion", (Say("prompt", "user"), Say("completion", ASSISTANT))),
    Mapping("prompt-system", (Say("system", "system"), Say("prompt", "user"), Say("response", ASSISTANT))),
    Mapping("question", (Say("question", "user"), Say("answer", ASSISTANT))),
    Mapping("instruction", (Say("instruction", "user"), Say("output", ASSISTANT))),
    Mapping("instruction-input", (Say("instruction", "user"), Say("input", "user", True), Say("output", ASSISTANT))),
    Mapping("instruction-system", (Say("system", "system"), Say("instruction", "user"), Say("output", ASSISTANT))),
    Mapping("nested", (Say("data.system", "system", True), Say("data.prompt.text", "user"), Say("data.reply.text", ASSISTANT))),
)


def fingerprint(paths: frozenset[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _registry(mappings: tuple[Mapping, ...]) -> tuple[dict[str, Mapping], frozenset[str]]:
    """Mappings by fingerprint; an empty list of messages leaves only its own path."""
    by: dict[str, Mapping] = {}
    known: set[str] = set()
    for m in mappings:
        lists = {s.path for s in m.steps if isinstance(s, Each)}
        empty = frozenset({p for p in m.paths if "[]" not in p} | {f"{p}[]" for p in lists})
        for paths in {m.paths, empty} if lists else {m.paths}:
            if fingerprint(paths) in by:
                raise ValueError(f"two layouts have the same fields: {m.layout}")
            by[fingerprint(paths)] = m
            known |= paths
    return by, frozenset(known)


def field_paths(value: object, path: str = "") -> set[str]:
    """Paths of all leaves: names joined by dots, ``[]`` for the items of a list."""
    if isinstance(value, dict):
        out = set()
        for k, v in value.items():
            out |= field_paths(v, f"{path}.{k}" if path else str(k))
        return out
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{path}[]") for v in value)) if value else {f"{path}[]"}
    return {path}


def _at(value: object, path: str) -> object:
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: object, mapping: Mapping) -> list[tuple[str, str]]:
    out = []
    for s in mapping.steps:
        if isinstance(s, Say):
            text = _text(_at(record, s.path))
            if text or not s.optional:
                out.append((s.role, text))
        else:
            names = dict(s.names)
            for m in _at(record, s.path) or []:
                role = _text(m.get(s.role))
                out.append((names.get(role, role), _text(m.get(s.text))))
    return out


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def _unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The string, and the spans (code points) of the assistant's texts in it."""
    parts, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"{START}{_escape_role(role)}\n", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns read back from a rendered string."""
    out, at = [], 0
    while at < len(formatted):
        head = formatted.index("\n", at)
        end = formatted.index(END, head + 1)
        out.append((_unescape_role(formatted[at + len(START) : head]), unescape(formatted[head + 1 : end])))
        at = end + len(END) + 1
    return out


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_chats(records: DataFrame, id_col: str, json_col: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Per record: id, fingerprint, layout, turns, formatted, loss_spans."""
    by, known = _registry(mappings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                try:
                    record = json.loads(value.as_py() or "null")
                except ValueError:
                    record = None
                print_ = fingerprint(frozenset(field_paths(record)) & known) if isinstance(record, dict) else None
                mapping = by.get(print_)
                turns = turns_of(record, mapping) if mapping else []
                formatted, spans = render(turns)
                rows.append((
                    print_, mapping.layout if mapping else None, [{"role": r, "text": t} for r, t in turns], formatted,
                    [{"start": a, "end": b} for a, b in spans],
                ))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.string(), pa.string(), _TURNS, pa.string(), _SPANS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["id", "fingerprint", "layout", "turns", "formatted", "loss_spans"],
            )

    kind = records.schema[id_col].dataType.simpleString()
    return records.select(F.col(id_col).alias("id"), F.col(json_col).alias("json")).mapInArrow(
        run,
        f"id {kind}, fingerprint string, layout string, turns array<struct<role: string, text: string>>, formatted string, "
        "loss_spans array<struct<start: long, end: long>>",
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Digests taken from the formatted string and its loss mask alone: id,
    layout, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    names = ["id", "layout", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, spans in zip(batch.column(2), batch.column(3), strict=True):
                s = value.as_py()
                turns = parse(s)
                told = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescape(s[x["start"] : x["end"]]) for x in spans.as_py())
                rows.append((len(turns), _digest(told), len(loss), _digest(loss), len(s)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    kind = chats.schema["id"].dataType.simpleString()
    return chats.select("id", "layout", "formatted", "loss_spans").mapInArrow(
        run, f"id {kind}, layout string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def records_of(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Records (id, json) of a table with a row a turn: turns in order (ties by
    role, then text), each conversation in the layout that its roles fit."""
    turn = F.struct(
        F.col(turn_col).isNull().alias("last"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    d = rows.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.concat_ws(",", F.transform("t", lambda t: F.regexp_replace(t.role, ",", "?")))
    said = lambda i: F.get("t", i)["text"]
    name = lambda r: F.when(r == "user", "human").when(r == ASSISTANT, "gpt").otherwise(r)
    plain = F.forall("t", lambda t: t.role.isin("system", "user", ASSISTANT))
    return d.select(
        "id",
        F.when(roles == "user,assistant", F.to_json(F.struct(said(0).alias("prompt"), said(1).alias("response"))))
        .when(roles == "system,user,assistant", F.to_json(F.struct(said(0).alias("system"), said(1).alias("instruction"), said(2).alias("output"))))
        .when(
            plain,
            F.to_json(F.struct(F.transform("t", lambda t: F.struct(name(t.role).alias("from"), t.text.alias("value"))).alias("conversations"))),
        )
        .otherwise(F.to_json(F.struct(F.transform("t", lambda t: F.struct(t.role.alias("role"), t.text.alias("content"))).alias("messages"))))
        .alias("json"),
    )
