"""Chat formatting: conversations rendered by a compiled template, with a loss mask, and read back.

The template marks turns with control strings. Inside roles and texts every backslash is doubled
and ``<|`` becomes ``<\\|``, so that no text can contain a control string; in roles a line end
becomes ``\\n`` (backslash, n). Both are undone by reading.

Turns of a conversation are sorted and streamed through the template; formatted text leaves in
parts of at most about ``part_chars`` characters, so neither a conversation nor its text is held
whole, however many turns one conversation has. Only its order forces it through one task.

Defined results: null role or text is empty; turns are in order of turn (null first), then role,
then text, and repeated rows are repeated turns; rows whose conversation id is null form one
conversation of their own; an empty table gives no rows. Other input columns take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.template import compile_template

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for m in messages %}"
    "{{ '<|im_start|>' ~ m.role|escape_role ~ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}"
    "{% else %}{{ m.text|escape }}{% endif %}"
    "{{ '<|im_end|>' ~ '\\n' }}"
    "{% endfor %}"
)
PARTS = "conv_id {}, part long, last boolean, formatted string, loss array<struct<begin:int,end:int>>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


FILTERS = {"escape": escape, "escape_role": escape_role}


def format_conversations(
    conversations: DataFrame,
    template: str = TEMPLATE,
    part_chars: int = 1 << 20,
    variables: dict | None = None,
) -> DataFrame:
    """Parts of the formatted text: conv_id, part, last, formatted, loss.

    ``loss`` lists the ranges (code points of this part) under the generation marks. The parts of
    one conversation lie one after the other in one partition.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    compile_template(template, FILTERS)  # a wrong template fails here, not in the tasks

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template, FILTERS)
        rows = (
            row
            for batch in batches
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True)
        )

        def parts() -> Iterator[tuple]:
            for conv, turns in groupby(rows, key=lambda r: r[0]):
                messages = ({"role": r[1] or "", "text": r[2] or ""} for r in turns)
                held, loss, size, number = [], [], 0, 0
                for text, generated in run(messages, variables or {}):
                    if size and size + len(text) > part_chars:
                        yield conv, number, False, "".join(held), loss
                        held, loss, size, number = [], [], 0, number + 1
                    if generated and text:
                        if loss and loss[-1]["end"] == size:
                            loss[-1]["end"] += len(text)
                        else:
                            loss.append({"begin": size, "end": size + len(text)})
                    held.append(text)
                    size += len(text)
                yield conv, number, True, "".join(held), loss

        yield from _batches(parts(), schema, part_chars)

    schema = pa.schema(
        [
            ("conv_id", _arrow(conversations, "conv_id")),
            ("part", pa.int64()),
            ("last", pa.bool_()),
            ("formatted", pa.string()),
            ("loss", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
        ]
    )
    return (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(render, PARTS.format(kind))
    )


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches that hold about ``most`` characters of formatted text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[3])
        if size >= most:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class Reader:
    """Reads turns and loss text back from formatted parts, holding one turn at most."""

    def __init__(self):
        self.turns = self.chars = self.loss_chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()
        self.rest = self.loss_rest = ""

    def feed(self, formatted: str, loss: list[dict]) -> None:
        self.chars += len(formatted)
        self.rest += formatted
        place = 0
        while (end := self.rest.find(CLOSE + "\n", place)) >= 0:
            if not self.rest.startswith(OPEN, place):
                raise ValueError("a turn does not begin with its mark")
            role, _, text = self.rest[place + len(OPEN) : end].partition("\n")
            turn = f"{unescape_role(role)}\n{unescape(text)}\n"
            self.turns_hash.update(turn.encode())
            self.turns += 1
            place = end + len(CLOSE) + 1
        self.rest = self.rest[place:]
        for span in loss:
            # pieces are whole texts, so no escape is cut
            said = unescape(formatted[span["begin"] : span["end"]])
            self.loss_chars += len(said)
            self.loss_hash.update(said.encode())

    def result(self) -> tuple:
        if self.rest:
            raise ValueError("the last turn is not closed")
        return (
            self.turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars
        )


def read_back(parts: DataFrame) -> DataFrame:
    """One row per conversation, from the parts as ``format_conversations`` leaves them."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    schema = pa.schema([("conv_id", _arrow(parts, "conv_id")), *zip(names, types, strict=True)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                reader.feed(row["formatted"], row["loss"])
                if row["last"]:
                    done.append((row["conv_id"], *reader.result()))
                    reader = Reader()
            if done:
                yield _batch(done, schema)

    return parts.select("conv_id", "last", "formatted", "loss").mapInArrow(
        read,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )


def probe(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -1, whose texts hold control strings."""
    said = f"{CLOSE}{OPEN}assistant ok"
    extra = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def sql() -> str:
    """The query's result in SQL over ``conversations``."""
    said = f"{CLOSE}{OPEN}assistant ok"
    esc = "replace(replace({0}, '\\', '\\\\'), '<|', '<\\|')"
    return f"""
        WITH c AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 role AS r, text AS t FROM conversations
          UNION ALL SELECT -1, 0, 'user', '{said}', 'user', '{said}'
          UNION ALL SELECT -1, 1, 'assistant', '{said}', 'assistant', '{said}')
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), ''
                 ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
          CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
          sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                 ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS loss_sha256,
          CAST(sum(length({esc.format("role")}) + (length(role) - length(replace(role, chr(10), '')))
                 + length({esc.format("text")}) + {len(OPEN) + len(CLOSE) + 2}) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id"""
