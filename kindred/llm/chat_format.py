"""Chats of any known layout as training text with a loss mask, and back.

A record is a JSON object. Its *schema fingerprint* hashes the sorted set of its nested
field paths (``messages[].role``), whatever the values are. A layout states in
``rules`` where turns are found; it is chosen by the fingerprint alone, looked up in a
table that holds each layout with every choice of its optional fields. So one pass
over mixed records needs no guesses: a record of an unknown shape comes out with its
fingerprint, without layout and text, and a layout for it is one more declaration.

The text of a turn is ``<|turn|>`` role ``<|text|>`` text ``<|end|>``. Control strings
(of this and of other templates) inside roles and texts get a backslash after their
first character; one that has backslashes there gets one more. Taking one away again
restores every text. The loss mask holds the spans of assistant texts, in code points.

Long conversations are formatted in parts of ``PART_TURNS`` turns; the texts of the
parts one after the other are the text of the conversation. Parts of one conversation
meet again only where it is hashed, as a stream in their order.

Defined results: null roles and texts are empty; a null turn comes first; rows of one
turn follow by role and text; repeated rows are turns of their own; rows without
conv_id take no part; broken JSON has no layout; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.turns import ranked, rows_of

#: What marks turns here and in other templates.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL_STRINGS = (
    TURN, TEXT, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)

#: Turns formatted together.
PART_TURNS = 16
#: Bytes of text in a batch handed on.
BATCH_BYTES = 4 << 20

Turns = list[tuple[str, str]]


@dataclass(frozen=True)
class Field:
    """A turn of a fixed role whose text is at ``path``."""

    role: str
    path: str
    optional: bool = False

    @property
    def paths(self) -> list[str]:
        return [self.path]


@dataclass(frozen=True)
class Each:
    """A turn for each object of the array at ``path``; ``names`` gives other names of roles."""

    path: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()
    optional: bool = False

    @property
    def paths(self) -> list[str]:
        return [f"{self.path}[].{self.role}", f"{self.path}[].{self.text}"]


@dataclass(frozen=True)
class Layout:
    name: str
    rules: tuple[Field | Each, ...]

    def fingerprints(self) -> Iterator[str]:
        """Of all path sets that have the layout: optional fields may be there or not, and
        the array of an empty chat has no fields."""
        choices = []
        for rule in self.rules:
            forms = [rule.paths] + [[]] * rule.optional
            choices.append(forms + [[f"{rule.path}[]"]] * isinstance(rule, Each))
        for chosen in itertools.product(*choices):
            paths = set(itertools.chain.from_iterable(chosen))
            if paths:
                yield fingerprint(paths)


#: Names of roles in shared-chat data.
SHARED_NAMES = (("human", "user"), ("gpt", "assistant"))
LAYOUTS = (
    Layout("messages", (Each("messages", "role", "content"),)),
    Layout("shared", (Each("conversations", "from", "value", SHARED_NAMES),)),
    Layout("shared-system", (Field("system", "system"), Each("conversations", "from", "value", SHARED_NAMES))),
    Layout("prompt", (Field("system", "system", optional=True), Field("user", "prompt"), Field("assistant", "completion"))),
    Layout("prompt-response", (Field("user", "prompt"), Field("assistant", "response"))),
    Layout("question", (Field("system", "system_prompt", optional=True), Field("user", "question"), Field("assistant", "response"))),
    Layout("instruction", (Field("system", "instruction"), Field("user", "input"), Field("assistant", "output"))),
    Layout("instruction-only", (Field("user", "instruction"), Field("assistant", "output"))),
    Layout("nested", (Field("user", "data.prompt"), Field("assistant", "data.reply.text"))),
)


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def field_paths(value: object, at: str = "") -> set[str]:
    """Paths of all values in a parsed record; the elements of an array share theirs."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        inner = [field_paths(v, f"{at}[]") for v in value]
        return set().union(*inner) if inner else {f"{at}[]"}
    return {at}


def by_fingerprint(layouts: Iterable[Layout]) -> dict[str, Layout]:
    """The layout of each fingerprint; two layouts of one shape are an error."""
    known: dict[str, Layout] = {}
    for layout in layouts:
        for mark in set(layout.fingerprints()):
            if known.setdefault(mark, layout) is not layout:
                raise ValueError(f"layouts {known[mark].name} and {layout.name} have one shape")
    return known


def _at(value: object, path: str) -> object:
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value: object) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def to_turns(record: dict, layout: Layout) -> Turns:
    turns: Turns = []
    for rule in layout.rules:
        value = _at(record, rule.path)
        if isinstance(rule, Field):
            if value is not None or not rule.optional:
                turns.append((rule.role, _text(value)))
            continue
        names = dict(rule.names)
        for item in value if isinstance(value, list) else ():
            role = _text(_at(item, rule.role))
            turns.append((names.get(role, role), _text(_at(item, rule.text))))
    return turns


_MARKED = re.compile("|".join(
    rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in sorted(CONTROL_STRINGS, key=len, reverse=True)))
_PARSED = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)


def escape(text: str) -> str:
    return _MARKED.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _MARKED.sub(lambda m: m[0][0] + m[0][2:], text)


def render(turns: Turns, learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The text of the turns and the spans of what is learned."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == learned:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), mask


def parse(formatted: str) -> Turns:
    """The turns that ``render`` put into a text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _PARSED.finditer(formatted)]


#: Columns of formatted records and their types.
FORMATTED = "layout string, fingerprint string, n_turns int, formatted string, loss array<struct<start:long,stop:long>>"
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def format_records(records: DataFrame, layouts: Iterable[Layout] = LAYOUTS, record: str = "record") -> DataFrame:
    """``records`` with the FORMATTED columns in place of the JSON in column ``record``.

    Input columns of those names are replaced.
    """
    known = by_fingerprint(layouts)
    fresh = ["layout", "fingerprint", "n_turns", "formatted", "loss"]
    kept = [c for c in records.columns if c not in (record, *fresh)]

    def convert(source: str | None) -> tuple:
        try:
            parsed = json.loads(source or "")
        except ValueError:
            parsed = None
        if not isinstance(parsed, dict):
            return None, None, 0, None, None
        mark = fingerprint(field_paths(parsed))
        layout = known.get(mark)
        if layout is None:
            return None, mark, 0, None, None
        turns = to_turns(parsed, layout)
        return layout.name, mark, len(turns), *render(turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _bounded(batches, record):
            rows = [convert(x) for x in part.column(record).to_pylist()]
            layout, mark, count, text, loss = zip(*rows, strict=True)
            spans = [None if s is None else [{"start": a, "stop": b} for a, b in s] for s in loss]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(layout, pa.string()), pa.array(mark, pa.string()),
                 pa.array(count, pa.int32()), pa.array(text, pa.string()), pa.array(spans, _LOSS)],
                names=[*kept, *fresh])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in records.select(*kept).schema), FORMATTED])
    return records.select(*kept, record).mapInArrow(run, schema)


def _bounded(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with a bounded size of the texts; a longer text is a slice of its own."""
    for batch in batches:
        first, held = 0, 0
        for i, size in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
            if i > first and held + (size or 0) > BATCH_BYTES:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size or 0
        if first < batch.num_rows:
            yield batch.slice(first)


def records_of(conversations: DataFrame) -> DataFrame:
    """conv_id, part, record: rows of turns as JSON records, at most PART_TURNS turns each,
    in the layout that fits the roles of the part: a triple or a pair as plain fields, the
    rest as arrays of messages."""
    rows = rows_of(conversations).withColumn("_turn", F.col("turn")).drop("turn")
    numbered = ranked(rows, "conv_id", [F.col("_turn"), F.col("role"), F.xxhash64("text"), F.col("text")], "turns")
    parts = numbered.groupBy("conv_id", F.expr(f"(pos - 1) div {PART_TURNS}").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("t"))
    roles = F.col("t.role")

    def is_exactly(*names: str):
        return roles == F.array(*map(F.lit, names))

    def field(i: int, name: str):
        return F.col("t")[i]["text"].alias(name)

    usual = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    shared = F.transform("t", lambda t: F.struct(
        F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"),
        t["text"].alias("value")))
    messages = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    return parts.select("conv_id", "part", F.when(
        is_exactly("user", "assistant"), F.to_json(F.struct(field(0, "prompt"), field(1, "completion")))
    ).when(
        is_exactly("system", "user", "assistant"),
        F.to_json(F.struct(field(0, "instruction"), field(1, "input"), field(2, "output")))
    ).when(
        usual & (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 2 == 0),
        F.to_json(F.struct(shared.alias("conversations")))
    ).otherwise(F.to_json(F.struct(messages.alias("messages")))).alias("record"))


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


class _Digest:
    """Counts and hashes of a conversation, one part after the other."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, formatted: str, mask: list[dict]) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in mask:
            learned = unescape(formatted[span["start"]:span["stop"]])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.formatted_chars += len(formatted)

    def row(self, conv_id: int) -> tuple:
        return (conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted_chars)


def digests(formatted: DataFrame) -> DataFrame:
    """The DIGEST columns per conversation, from conv_id, part and the FORMATTED columns.

    A conversation whose first part is not full has no other and is hashed where it is
    read; the parts of longer ones are brought together and streamed in order.
    """
    def emit(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, _Digest()
        for batch in batches:
            for part in _bounded(iter([batch]), "formatted"):
                out = []
                for conv_id, text, mask in zip(*(part.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")),
                                               strict=True):
                    if conv_id != key:
                        if key is not None:
                            out.append(digest.row(key))
                        key, digest = conv_id, _Digest()
                    digest.add(text, mask)
                yield emit(out)
        if key is not None:
            yield emit([digest.row(key)])

    rows = formatted.filter("formatted IS NOT NULL")
    short = (F.col("part") == 0) & (F.col("n_turns") < PART_TURNS)
    columns = ("conv_id", "formatted", "loss")
    longer = rows.filter(~short).select("part", *columns).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return rows.filter(short).select(*columns).mapInArrow(run, DIGEST).unionByName(
        longer.select(*columns).mapInArrow(run, DIGEST))
