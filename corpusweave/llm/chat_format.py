"""Chat formatting: schema fingerprints choose mappings into canonical turns, turns become text.

Records of different layouts come as JSON. The nested field paths of a record, without values and
list positions, make its fingerprint, and the fingerprint chooses a declarative mapping from paths to
turns. A record that no mapping fits is a row of its own with a reason, and stops nothing. Turns are
written with marks around role and text; marks inside a role or text are escaped with a backslash,
reversibly. Everything is done turn by turn, so a conversation of any length passes through in parts of
bounded size, and through as many tasks as it needs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.ordered import with_ordered

# Marks of the template, and other strings that a model may read as marks.
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
# A mark inside a text gets one more backslash behind its first character; backslashes already
# there count on, so taking one away gives the text back.
_FIRST = sorted({c[0] for c in CONTROLS})
ESCAPE = re.compile("|".join(f"(?<={re.escape(f)})(?=\\\\*(?:{'|'.join(re.escape(c[1:]) for c in CONTROLS if c[0] == f)}))" for f in _FIRST))
UNESCAPE = re.compile("|".join(f"(?<={re.escape(f)})\\\\(?=\\\\*(?:{'|'.join(re.escape(c[1:]) for c in CONTROLS if c[0] == f)}))" for f in _FIRST))
TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(CLOSE) + "(.*?)" + re.escape(END), re.S)
ASSISTANT = "assistant"
# Characters after which a formatted conversation goes on in a new row.
PART_CHARS = 4 << 20


def escape(text: str) -> str:
    return ESCAPE.sub("\\\\", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub("", text)


def paths(value, at: str = "") -> set[str]:
    """Nested field paths of a record; list items share one path, and a null has its field's path."""
    if isinstance(value, dict):
        return {at} | set().union(*[paths(v, f"{at}.{k}") for k, v in value.items()]) if value else {at}
    if isinstance(value, list):
        return set().union({at + "[]"}, *[paths(v, at + "[]") for v in value])
    return {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha1("\n".join(sorted(found)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def _at(value, steps: Sequence[str]) -> list:
    """Values at a path; ``name[]`` goes into every item of a list."""
    if not steps:
        return [value]
    name = steps[0].removesuffix("[]")
    if not isinstance(value, dict) or name not in value:
        return []
    inner = value[name]
    if not steps[0].endswith("[]"):
        return _at(inner, steps[1:])
    return [found for item in inner for found in _at(item, steps[1:])] if isinstance(inner, list) else []


def _text(leaves: list, path: str) -> str:
    """Leaves of a path as one text: a null is empty, numbers and truth values are written as in JSON."""
    for leaf in leaves:
        if isinstance(leaf, (dict, list)):
            raise ValueError(f"the text at {path} is a {'list' if isinstance(leaf, list) else 'record'}")
    return "".join("" if x is None else x if isinstance(x, str) else json.dumps(x) for x in leaves)


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.

    ``fields``: the paths a record of the layout has, ``optional``: those it may have besides. A path is
    names joined by dots, with ``[]`` behind a list. ``turns``: (role, path of the text) in order, for
    layouts with a field for each role; a missing text makes no turn, a null one an empty turn.
    ``items``: for layouts with a list of messages, the path of the list and the paths of role and text in
    an item. A text path through a list joins its texts.
    """

    fields: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    items: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()

    def fingerprints(self) -> set[str]:
        """Of the fields with any choice of the optional ones, and of an empty or null list of messages."""
        made = set()
        extra = [[]]
        for field in self.optional:
            extra += [e + [field] for e in extra]
        for chosen in extra:
            found = {""}
            for field in [*self.fields, *chosen]:
                steps = field.split(".")
                found |= {"." + ".".join(steps[: k + 1]) for k in range(len(steps))}
            made.add(fingerprint(found))
            if self.items is not None:
                inside = "." + self.items[0] + "[]"
                outer = {p for p in found if not p.startswith(inside)}
                made |= {fingerprint(outer | {inside}), fingerprint(outer | {"." + self.items[0]})}
        return made

    def apply(self, record) -> list[tuple[str, str]]:
        if self.items is not None:
            where, role, text = self.items
            items = _at(record, (where + "[]").split("."))
            return [
                (_text(_at(m, role.split(".")), role), _text(_at(m, text.split(".")), f"{where}[].{text}")) for m in items
            ]
        found = [(role, path, _at(record, path.split("."))) for role, path in self.turns]
        return [(role, _text(leaves, path)) for role, path, leaves in found if leaves]


def _fields(*turns: tuple[str, str], optional: tuple[str, ...] = ()) -> Mapping:
    return Mapping(tuple(path for _, path in turns), turns=turns, optional=optional)


def _list(where: str, role: str, text: str, *more: str, optional: tuple[str, ...] = ()) -> Mapping:
    inside = tuple(f"{where}[].{f}" for f in (role, text, *more))
    return Mapping(inside, items=(where, role, text), optional=tuple(f"{where}[].{f}" for f in optional))


LAYOUTS = (
    _fields(("user", "prompt"), ("assistant", "completion")),
    _fields(("user", "prompt"), ("assistant", "response")),
    _fields(("user", "prompt")),
    _fields(("assistant", "completion")),
    _fields(("system", "system")),
    _fields(("user", "question"), ("assistant", "answer")),
    _fields(("user", "instruction"), ("assistant", "output")),
    _fields(("system", "instruction"), ("user", "input"), ("assistant", "output")),
    _fields(("system", "system"), ("user", "instruction"), ("assistant", "output")),
    _fields(("user", "data.prompt"), ("assistant", "data.answer")),
    _list("messages", "role", "content", optional=("name", "weight")),
    _list("messages", "role", "content[].text", "content[].type"),
    _list("conversations", "from", "value"),
    _list("turns", "role", "text"),
)
# Names of roles in other layouts; other roles stay as they are.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


class Layouts:
    """Mappings by fingerprint."""

    def __init__(self, layouts: Sequence[Mapping] = LAYOUTS, roles: dict[str, str] | None = None):
        self.by_print = {p: m for m in layouts for p in m.fingerprints()}
        self.roles = ROLES if roles is None else roles

    def turns(self, record: str | None) -> list[tuple[str, str]]:
        """Turns of a JSON record; a ValueError says why there are none that can be told."""
        if record is None:
            return []
        value = json.loads(record)
        found = paths(value)
        mapping = self.by_print.get(fingerprint(found))
        if mapping is None:
            raise ValueError(f"no mapping for a record with the fields {sorted(found)[:20]}")
        return [(self.roles.get(role, role), text) for role, text in mapping.apply(value)]


def fingerprints(records: DataFrame, record: str = "record") -> DataFrame:
    """(fingerprint, n, example paths) of all layouts in a table, to write mappings from."""

    def run(batches):
        for batch in batches:
            seen: dict[str, list] = {}
            for value in batch.column("record").to_pylist():
                try:
                    found = paths(json.loads(value)) if value is not None else set()
                except (ValueError, RecursionError):
                    found = {"not JSON"}
                row = seen.setdefault(fingerprint(found), [0, sorted(found)])
                row[0] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(seen), pa.string()),
                    pa.array([r[0] for r in seen.values()], pa.int64()),
                    pa.array([r[1] for r in seen.values()], pa.list_(pa.string())),
                ],
                names=["fingerprint", "n", "paths"],
            )

    found = records.select(F.col(f"`{record}`").alias("record")).mapInArrow(
        run, "fingerprint string, n long, paths array<string>"
    )
    return found.groupBy("fingerprint").agg(F.sum("n").alias("n"), F.min("paths").alias("paths"))


def converted(
    records: DataFrame, record: str = "record", key: str = "conv_id", order: str = "position",
    layouts: Sequence[Mapping] = LAYOUTS, roles: dict[str, str] | None = None,
) -> DataFrame:
    """(conv_id, position, step, role, text, reason): the turns of every record, ``step`` counting inside it.

    A record that is not JSON, has no mapping or no text where one should be is one row with a reason, the
    record as its text, and neither step nor role. A null record has no turns; a null text is an empty turn.
    Other columns are left out.
    """
    kinds = {f.name: f.dataType.simpleString() for f in records.schema.fields}

    def run(batches):
        known = Layouts(layouts, roles)
        for batch in batches:
            at, flat = [], []
            for row, value in enumerate(batch.column("record").to_pylist()):
                try:
                    turns = [(k, role, text, None) for k, (role, text) in enumerate(known.turns(value))]
                except RecursionError:
                    turns = [(None, None, value, "the record is nested too deeply")]
                except ValueError as error:
                    turns = [(None, None, value, str(error))]
                flat += turns
                at += [row] * len(turns)
            columns = list(zip(*flat, strict=True)) or [[], [], [], []]
            kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("conv_id", "position")]
            types = (pa.int32(), pa.string(), pa.string(), pa.string())
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*kept, *made], names=["conv_id", "position", "step", "role", "text", "reason"]
            )

    source = records.select(
        F.col(f"`{key}`").alias("conv_id"),
        F.col(f"`{order}`").alias("position"),
        F.col(f"`{record}`").cast("string").alias("record"),
    )
    schema = f"conv_id {kinds[key]}, position {kinds[order]}, step int, role string, text string, reason string"
    return source.mapInArrow(run, schema)


def canonical_turns(records: DataFrame, *args, **options) -> DataFrame:
    """(conv_id, position, step, role, text): the turns of ``converted``; ``rejected`` has the other records."""
    return converted(records, *args, **options).filter("reason IS NULL").drop("reason")


def rejected(records: DataFrame, *args, **options) -> DataFrame:
    """(conv_id, position, record, reason): the records that no mapping could read, to be counted or mapped."""
    return converted(records, *args, **options).filter("reason IS NOT NULL").select(
        "conv_id", "position", F.col("text").alias("record"), "reason"
    )


def turn_rows(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Canonical turns from a table with a row per turn."""
    return turns.select(
        F.col(f"`{key}`").alias("conv_id"),
        F.col(f"`{order}`").alias("position"),
        F.lit(0).alias("step"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )


def _by_key(batches, columns: Sequence[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns], strict=True)


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def render(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, formatted, loss): text of each conversation and the spans that carry loss.

    ``loss`` has the (begin, end) characters of assistant texts inside ``formatted``, escapes
    included. A conversation that passes ``part_chars``, or a border between tasks, goes on in another part,
    cut between turns; the numbers of parts ascend. Ties in order are put in order by role and text; null
    keys form one conversation. Turns are dealt to tasks in ranges, so a long conversation has several.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, part long, formatted string, loss array<struct<begin:int,end:int>>"
    arrow = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        rows: list[tuple] = []
        held = 0
        # Ranges ascend with the number of the task.
        first = TaskContext.get().partitionId() << 32
        now, part, texts, spans, size = None, -1, [], [], 0

        def close():
            nonlocal texts, spans, size, held
            if texts:
                rows.append((now, part, "".join(texts), spans))
                held += size
            texts, spans, size = [], [], 0

        def flush():
            nonlocal rows, held
            columns = list(zip(*rows, strict=True))
            rows, held = [], 0
            kinds = (None, pa.int64(), pa.string(), arrow)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, key_type if k is None else k) for c, k in zip(columns, kinds, strict=True)],
                names=["conv_id", "part", "formatted", "loss"],
            )

        key_type = None
        for batch in batches:
            key_type = batch.schema.field("conv_id").type
            for key, role, text in _by_key([batch], ("conv_id", "role", "text")):
                if part < 0 or key != now:
                    close()
                    now, part = key, first
                elif size >= part_chars:
                    close()
                    part += 1
                head = f"{OPEN}{escape(role)}{CLOSE}"
                body = escape(text)
                if role == ASSISTANT:
                    spans.append({"begin": size + len(head), "end": size + len(head) + len(body)})
                texts.append(f"{head}{body}{END}")
                size += len(texts[-1])
                if held >= part_chars and rows:
                    yield flush()
        close()
        if rows:
            yield flush()

    order = ["conv_id", "position", "step", "role", "text"]
    dealt = turns.select(*order).repartitionByRange(_parts(turns), *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, schema)


def parsed(formatted: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, turns, loss, chars): every part read back, wherever it lies.

    ``turns`` is role, line end, text, line end of each turn, ``loss`` the text below the loss mask; both
    are unescaped.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def read(text: str, spans) -> tuple:
        at, turns = 0, []
        for match in TURN.finditer(text):
            if match.start() != at:
                raise ValueError("formatted text between turns")
            at = match.end()
            turns.append("{}\n{}\n".format(*map(unescape, match.groups())))
        if at != len(text):
            raise ValueError("formatted text behind the last turn")
        loss = "".join(unescape(text[s["begin"] : s["end"]]) for s in spans)
        return len(turns), "".join(turns), loss, len(text)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                found = read(row.column("formatted")[0].as_py(), row.column("loss")[0].as_py())
                arrays = [row.column("conv_id"), row.column("part")]
                arrays += [pa.array([v], t) for v, t in zip(found, (pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "part", "n_turns", "turns", "loss", "chars"])

    return formatted.mapInArrow(run, f"conv_id {kind}, part long, n_turns long, turns string, loss string, chars long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation from its formatted parts.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): the turns as parsed and
    unescaped, and the text below the loss mask, unescaped. Parts are parsed where they are; a digest has to
    see its conversation in order, so one task hashes the parsed parts as they pass by.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )

    def run(batches):
        rows, now, state, key_type = [], None, None, None

        def close():
            if state is not None:
                n, turns, chars, loss, size = state
                rows.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            key_type = batch.schema.field("conv_id").type
            for key, n, turns, loss, chars in _by_key([batch], ("conv_id", "n_turns", "turns", "loss", "chars")):
                if state is None or key != now:
                    close()
                    now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += n
                state[1].update(turns.encode("utf-8", "surrogatepass"))
                state[2] += len(loss)
                state[3].update(loss.encode("utf-8", "surrogatepass"))
                state[4] += chars
            if len(rows) >= 10_000:
                yield _digest_rows(rows, key_type)
                rows = []
        close()
        if rows:
            yield _digest_rows(rows, key_type)

    sent = parsed(formatted).repartition(_parts(formatted), "conv_id").sortWithinPartitions("conv_id", "part")
    return sent.mapInArrow(run, schema)


def _digest_rows(rows: list[tuple], key_type) -> pa.RecordBatch:
    kinds = (key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def mixed_layouts(turns: DataFrame) -> DataFrame:
    """(conv_id, position, record): turns as JSON records in all layouts that data sets come in.

    One to three consecutive turns make a record. How many and which layout depends on digests; a layout with
    a field for each role takes turns of just these roles. A null role is an empty one, a null text too.
    """
    # A null conversation is one like others: its turns are numbered under a name that no number has.
    rows = turns.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    placed = with_ordered(rows, ["conv"], ["turn", "role", "text"], index="at")
    size = F.pmod(F.xxhash64("conv"), F.lit(3)) + 1
    groups = placed.groupBy("conv", F.floor(F.col("at") / size).alias("position")).agg(
        F.first("conv_id").alias("conv_id"),
        F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("m"),
    )
    text = lambda k: F.get("m", F.lit(k))["text"]
    draw = F.pmod(F.xxhash64("conv", "position", F.lit(1)), F.lit(12))
    record = lambda *names: F.to_json(F.struct(*[text(k).alias(n) for k, n in enumerate(names)]))
    listed = lambda where, a, b: F.to_json(
        F.struct(F.transform("m", lambda t: F.struct(t["role"].alias(a), t["text"].alias(b))).alias(where))
    )
    piece = lambda t: F.array(F.struct(F.lit("text").alias("type"), t["text"].alias("text")))
    nested = F.to_json(F.struct(F.transform("m", lambda t: F.struct(t["role"], piece(t).alias("content"))).alias("messages")))
    named = F.to_json(
        F.struct(
            F.transform("m", lambda t: F.struct(t["role"], t["text"].alias("content"), F.lit("n").alias("name"))).alias("messages")
        )
    )
    inside = F.to_json(F.struct(F.struct(text(0).alias("prompt"), text(1).alias("answer")).alias("data")))
    roles = F.array_join(F.transform("m", lambda t: t["role"]), ",")
    n = F.size("m")
    lists = (
        F.when(draw % 6 == 0, listed("messages", "role", "content"))
        .when(draw % 6 == 1, listed("conversations", "from", "value"))
        .when(draw % 6 == 2, listed("turns", "role", "text"))
        .when(draw % 6 == 3, nested)
        .otherwise(named)
    )
    pairs = (
        F.when(draw == 0, record("prompt", "completion"))
        .when(draw == 1, record("prompt", "response"))
        .when(draw == 2, record("question", "answer"))
        .when(draw == 3, record("instruction", "output"))
        .when(draw == 4, inside)
        .otherwise(lists)
    )
    made = (
        F.when((n == 2) & (roles == "user,assistant"), pairs)
        .when((n == 3) & (roles == "system,user,assistant") & (draw < 4), record("instruction", "input", "output"))
        .when((n == 3) & (roles == "system,user,assistant") & (draw < 8), record("system", "instruction", "output"))
        .when((n == 1) & (roles == "user") & (draw < 6), record("prompt"))
        .when((n == 1) & (roles == "assistant") & (draw < 6), record("completion"))
        .when((n == 1) & (roles == "system") & (draw < 6), record("system"))
        .otherwise(lists)
    )
    return groups.select("conv_id", "position", made.alias("record"))
