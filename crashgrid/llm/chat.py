"""Chat formatting by columnar byte assembly.

A turn becomes

    ### role:
    text</turn>

and a newline. Control strings inside a role or text are escaped by a backslash
before them, a backslash by a second one, so a text can hold the template's own
marks and is read back as it was.

Turns are dealt by conversation and sorted by turn; a task then streams them.
For each chunk of rows the texts of the column are one byte array: the places of
control strings are found in it, escapes are scattered in, and header, role and
content segments are gathered into one preallocated Arrow buffer by index arrays
made from the segments' lengths and cumulative offsets. No turn is handled on
its own. A conversation up to ``PART_BYTES`` is one row; a longer one is several
rows in order, ``part`` 0, 1, ..., cut between turns, so a conversation that
holds a third of all rows is streamed and never held whole. Memory is bounded by
``PART_BYTES`` and the longest text.

Cases: a null role or text is empty; a null conversation id is a conversation;
turns that tie are ordered by role, then text, nulls first; repeated rows are
turns of their own. An empty table gives no rows. Further columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import byte_chunks

# The template (fixed values).
HEAD, SEP, END, ESCAPE = b"### ", b":\n", b"</turn>\n", b"\\"
IN_TEXT = (ESCAPE, HEAD, b"</turn>")
IN_ROLE = (*IN_TEXT, b":")
TRAINED_ROLE = b"assistant"

PART_BYTES = 4 << 20

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))

_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+):\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def _column_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and the ends of its values; null is empty."""
    array = pa.compute.fill_null(array.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def _found(data: np.ndarray, ends: np.ndarray, mark: bytes) -> np.ndarray:
    """Where ``mark`` starts in a value of the column."""
    at = np.flatnonzero(data == mark[0])
    row_end = ends[np.searchsorted(ends, at, side="right")] if len(at) else at
    at = at[at + len(mark) <= row_end]
    for i, byte in enumerate(mark[1:], 1):
        at = at[data[at + i] == byte]
    return at


def escape(data: np.ndarray, ends: np.ndarray, marks: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The values with an escape byte before each mark, and their new ends."""
    at = np.sort(np.concatenate([_found(data, ends, m) for m in marks]))
    if not len(at):
        return data, ends
    added = np.zeros(len(data), np.int64)
    added[at] = 1
    shift = np.cumsum(added)
    out = np.full(len(data) + len(at), ESCAPE[0], np.uint8)
    out[np.arange(len(data)) + shift] = data
    return out, ends + np.searchsorted(at, ends, side="left")


def assemble(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """The segments of ``pool`` one after the other in one Arrow buffer, and their ends."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    buffer = pa.allocate_buffer(total)
    source = np.repeat(starts - (ends - sizes), sizes) + np.arange(total)
    np.take(pool, source, out=np.frombuffer(buffer, np.uint8))
    return buffer, ends


def _characters_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 ``data`` before each of the byte places ``at``."""
    counts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=counts[1:])
    return counts[at]


def _whole_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of rows that end with a conversation, unless that is longer than a part."""
    rest = None
    for batch in byte_chunks(batches, 2, PART_BYTES):
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        ids = batch.column(0).to_pylist()
        last = len(ids) - 1
        while last > 0 and ids[last - 1] == ids[last]:
            last -= 1
        rest = batch.slice(last)
        if rest.nbytes >= PART_BYTES:
            last, rest = batch.num_rows, None
        if last:
            yield batch.slice(0, last)
    if rest is not None and rest.num_rows:
        yield rest


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, part, chars = object(), 0, 0  # the conversation under way, its parts and code points so far
    const = np.frombuffer(HEAD + SEP + END, np.uint8)
    for batch in _whole_conversations(batches):
        n = batch.num_rows
        roles, role_ends = _column_bytes(batch.column(1))
        trained = np.fromiter((r == TRAINED_ROLE for r in batch.column(1).cast(pa.binary()).to_pylist()), bool, n)
        roles, role_ends = escape(roles, role_ends, IN_ROLE)
        texts, text_ends = escape(*_column_bytes(batch.column(2)), IN_TEXT)
        role_sizes, text_sizes = np.diff(role_ends, prepend=0), np.diff(text_ends, prepend=0)
        at_sep, at_end, at_roles = len(HEAD), len(HEAD) + len(SEP), len(const)
        at_texts = at_roles + len(roles)
        starts, sizes = np.empty((n, 5), np.int64), np.empty((n, 5), np.int64)
        for i, (start, size) in enumerate([
            (0, len(HEAD)), (at_roles + role_ends - role_sizes, role_sizes), (at_sep, len(SEP)),
            (at_texts + text_ends - text_sizes, text_sizes), (at_end, len(END)),
        ]):
            starts[:, i], sizes[:, i] = start, size
        buffer, ends = assemble(np.concatenate([const, roles, texts]), starts.ravel(), sizes.ravel())
        ends = ends.reshape(n, 5)

        ids = batch.column(0).to_pylist()
        first = np.flatnonzero([i == 0 or ids[i] != ids[i - 1] for i in range(n)])
        after = np.append(first[1:], n)
        cuts = np.concatenate([[0], ends[after - 1, 4]])
        data = np.frombuffer(buffer, np.uint8)
        cut_chars = _characters_before(data, cuts)
        content = _characters_before(data, ends[:, [2, 3]])
        parts, mask, mask_ends = [], [], [0]
        for i, (a, b) in enumerate(zip(first, after)):
            if i or ids[a] != conv:
                conv, part, chars = ids[a], 0, 0
            parts.append(part)
            in_part = content[a:b][trained[a:b]] - cut_chars[i] + chars
            mask.append(in_part)
            mask_ends.append(mask_ends[-1] + len(in_part))
            part, chars = part + 1, chars + int(cut_chars[i + 1] - cut_chars[i])
        spans = np.concatenate(mask)
        formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(cuts.astype(np.int64)), buffer)
        yield pa.record_batch({
            "conv": batch.column(0).take(pa.array(first)),
            "part": pa.array(parts, pa.int32()),
            "n_turns": pa.array(after - first, pa.int64()),
            "formatted": formatted.cast(pa.string()),
            "loss": pa.ListArray.from_arrays(
                pa.array(mask_ends, pa.int32()),
                pa.StructArray.from_arrays([pa.array(spans[:, 0]), pa.array(spans[:, 1])], ["start", "end"]),
            ),
        })


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Rows ``conv_col, part, n_turns, formatted, loss``: the formatted text of
    each conversation and the code-point ranges of it, counted from the start of
    the conversation, that a model is trained on: the assistant's contents.
    Rows of a conversation are next to each other, parts in order."""
    role, text = F.col(role_col).cast("string"), F.col(text_col).cast("string")
    conv_type = turns.schema[conv_col].dataType
    dealt = (
        turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
        .repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    )
    out = T.StructType([
        T.StructField("conv", conv_type), T.StructField("part", T.IntegerType()), T.StructField("n_turns", T.LongType()),
        T.StructField("formatted", T.StringType()), T.StructField("loss", SPANS),
    ])
    return dealt.mapInArrow(_format, out).withColumnRenamed("conv", conv_col)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


class _Reading:
    """What has been read of one conversation."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str, loss: list[dict]) -> None:
        at = 0
        while at < len(formatted):
            turn = _TURN.match(formatted, at)
            if turn is None:
                raise ValueError(f"not a turn at {self.chars + at} of conversation {self.conv}")
            role, text = unescape(turn[1]), unescape(turn[2])
            self.digest.update(f"{role}\n{text}\n".encode())
            self.turns += 1
            at = turn.end()
        for span in loss:
            text = unescape(formatted[span["start"] - self.chars : span["end"] - self.chars])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv, self.turns, self.digest.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in byte_chunks(batches, 1, PART_BYTES):
            for conv, formatted, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now.conv:
                    done += [now.row()] if now else []
                    now = _Reading(conv)
                now.read(formatted, loss)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done), schema)] if done else [pa.array([], t.type) for t in schema], schema=schema)
            done = []
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(now.row(), schema)], schema=schema)

    return run


def read_back(formatted: DataFrame, conv_col: str = "conv_id", in_order: bool = False) -> DataFrame:
    """One row per conversation, parsed from its formatted text alone: ``n_turns``,
    ``turns_sha256`` of role, newline, text, newline per turn, ``loss_chars`` and
    ``loss_sha256`` of the unescaped text under the loss ranges, and
    ``formatted_chars``. ``in_order``: the rows come as
    :func:`format_conversations` makes them; otherwise they are dealt and sorted
    first. Text that the template cannot have made is an error."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if not in_order:
        formatted = formatted.repartition(conv_col).sortWithinPartitions(conv_col, "part")
    out = T.StructType([
        T.StructField("conv", formatted.schema[conv_col].dataType), T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    ])
    read = formatted.select(F.col(conv_col).alias("conv"), "formatted", "loss")
    return read.mapInArrow(_read(to_arrow_schema(out)), out).withColumnRenamed("conv", conv_col)
