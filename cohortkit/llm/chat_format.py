"""Chat formatting with mappings selected by schema fingerprint.

A record is a JSON object in any layout.  Its schema is the sorted list of its
nested field paths (``messages[].role``), and the fingerprint is a hash of it.
Each new fingerprint selects, once per task, the declarative mapping whose
paths it holds (the most specific one); the mapping turns records into
canonical turns.  Records that no mapping fits, and lines that are no JSON
object, become rejects with a reason.

The template writes a turn as ``<|im_start|>role\\n`` + text + ``<|im_end|>\\n``.
Inside texts and roles ``<`` + any backslashes + ``|`` gets one backslash more,
so no control string can stand there, and taking one away restores the text;
roles also escape backslashes and line ends.  The loss mask covers the text of
each assistant turn.  Turns are rows of the output, so a conversation of any
length is written and read back as a stream.

Defined results: null texts and roles are empty; turns come in order of
``turn``, then their place in the record, then role and text; a null
conversation id is one conversation; repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPED = re.compile(r"\\([\\n])")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.DOTALL)


@dataclass(frozen=True)
class Mapping:
    """``needs``: field paths that must be there.  ``each`` with ``role`` and
    ``text``: a list of turns.  ``turns``: fixed turns of one record, as a role
    (or ``@path`` to it) and the paths whose texts are joined by blank lines."""
    name: str
    needs: frozenset[str]
    each: str | None = None
    role: str = ""
    text: str = ""
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


MAPPINGS = (
    Mapping("messages", frozenset({"messages[].role", "messages[].content"}), "messages", "role", "content"),
    Mapping("conversations", frozenset({"conversations[].from", "conversations[].value"}), "conversations", "from", "value",
            roles={"human": "user", "gpt": "assistant"}),
    Mapping("prompt_completion", frozenset({"prompt", "completion"}),
            turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt_response", frozenset({"prompt", "response"}),
            turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("instruction", frozenset({"instruction", "output"}),
            turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("question_answer", frozenset({"question", "answer"}),
            turns=(("user", ("question",)), ("assistant", ("answer",)))),
    Mapping("turn_row", frozenset({"turn", "role", "text"}), turns=(("@role", ("text",)),)),
)


def field_paths(value: object, at: str = "") -> set[str]:
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in field_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {f"{at}[]"} | {p for v in value for p in field_paths(v, f"{at}[]")}
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


class Mapper:
    def __init__(self, mappings: Sequence[Mapping] = MAPPINGS):
        self.mappings, self.chosen = mappings, {}

    def select(self, record: dict) -> tuple[str, Mapping | None]:
        paths = field_paths(record)
        key = fingerprint(paths)
        if key not in self.chosen:
            fits = [m for m in self.mappings if m.needs <= paths or m.each and record.get(m.each) == []]
            self.chosen[key] = max(fits, key=lambda m: (m.needs <= paths, len(m.needs)), default=None)
        return key, self.chosen[key]

    def turns(self, record: dict, mapping: Mapping) -> list[tuple[str, str]]:
        if mapping.each:
            found = [(x.get(mapping.role), x.get(mapping.text)) for x in record[mapping.each] if isinstance(x, dict)]
        else:
            found = []
            for role, paths in mapping.turns:
                texts = [_text(record[p]) for p in paths if record.get(p) not in (None, "")]
                if texts or all(p in record for p in paths):
                    found.append((record.get(role[1:]) if role[0] == "@" else role, "\n\n".join(texts)))
            if len(found) > 1 and found[0] == ("system", ""):
                del found[0]
        return [(mapping.roles.get(_text(r), _text(r)), _text(t)) for r, t in found]


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def format_records(records: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", record_col: str = "record",
                   mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """Formatted turns ``(conv_id, turn, pos, fingerprint, mapping, role,
    chunk, loss_start, loss_end, reason)``: the loss mask is the characters
    ``loss_start:loss_end`` of the chunk (equal where nothing is learned).  A
    reject has a ``reason`` and no chunk."""
    rows = records.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(record_col).alias("record"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, turn long, pos int, fingerprint string, mapping string, role string, chunk string, "
              "loss_start long, loss_end long, reason string")
    names = ["pos", "fingerprint", "mapping", "role", "chunk", "loss_start", "loss_end", "reason"]
    types = [pa.int32(), *[pa.string()] * 4, pa.int64(), pa.int64(), pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapper = Mapper(mappings)
        for batch in batches:
            source, out = [], []
            for i, raw in enumerate(batch.column("record").to_pylist()):
                try:
                    record = json.loads(raw or "null")
                except ValueError:
                    record = None
                if not isinstance(record, dict):
                    source.append(i)
                    out.append((0, None, None, None, None, None, None, "not a JSON object"))
                    continue
                key, mapping = mapper.select(record)
                if mapping is None:
                    source.append(i)
                    out.append((0, key, None, None, None, None, None, "no mapping for its fields"))
                    continue
                for pos, (role, text) in enumerate(mapper.turns(record, mapping)):
                    head, body = f"{START}{escape_role(role)}\n", escape(text)
                    source.append(i)
                    out.append((pos, key, mapping.name, role, f"{head}{body}{END}\n", len(head),
                                len(head) + (len(body) if role == "assistant" else 0), None))
            own = pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn")], ["conv_id", "turn"]).take(pa.array(source, pa.int64()))
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([*own.columns, *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                                             ["conv_id", "turn", *names])

    return rows.mapInArrow(work, schema)


def parse_turn(chunk: str) -> tuple[str, str]:
    m = _TURN.fullmatch(chunk)
    if not m:
        raise ValueError("not a formatted turn")
    return unescape_role(m[1]), unescape(m[2])


def read_conversations(spark: SparkSession, path: str) -> DataFrame:
    """Digests of each formatted conversation in the folder ``path``, from
    parsing its chunks: ``(conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars)``.  The chunks of a conversation pass through
    one task as a sorted stream; nothing but the digests is held."""
    rows = spark.read.parquet(path).where(F.col("reason").isNull())
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done, conv_type = None, None, [], None

        def close() -> None:
            if state:
                n, turns, chars, loss, size = state
                done.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        def flush() -> pa.RecordBatch:
            types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*done, strict=True)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv, chunk, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "chunk", "loss_start", "loss_end")), strict=True):
                if state is None or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_turn(chunk)
                learned = unescape(chunk[a:b])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(chunk)
            yield flush()
            done.clear()
        close()
        if done:
            yield flush()

    order = ["conv_id", "turn", "pos", "role", "chunk"]
    return (rows.select(*order, "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions(*order)
            .mapInArrow(digest, schema))
