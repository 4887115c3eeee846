"""Chat formatting by columnar byte assembly.

A conversation ``<s>`` is followed by its turns, each
``<|role|>\\n`` text ``</s>\\n``.  Inside roles and texts the escape mark ``\\``
is doubled and the first byte of every control string is replaced by a letter
behind an escape mark, so no control string is left in them and the original
comes back exactly.

Rows of a conversation are brought together by one shuffle on its id and
sorted by turn; each Arrow batch is then assembled as columns: the lengths of
all segments (mark, role, mark, text, mark), their cumulative offsets, and the
scatter indices of every byte are computed with numpy, and headers and
contents are copied into one preallocated buffer that becomes the Arrow string
column.  A conversation is written in parts of bounded size, so none has to be
held whole however long it is.

The loss mask covers the text of assistant turns, as spans of code points of
a part.

Defined results: null roles and texts are empty; turns with equal numbers are
ordered by role, then text; repeated rows are all written; rows without a
conversation id form one conversation without id; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, batches_of, clean_text, ddl

# Fixed values of the template.
BEGIN, ROLE_OPEN, ROLE_CLOSE, TURN_CLOSE = "<s>", "<|", "|>\n", "</s>\n"
ASSISTANT = "assistant"
#: Strings that a model or template may read as control, with their escaped forms.
CONTROL_STRINGS = ["<s>", "</s>", "<|", "|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>", "<pad>"]
ESCAPE = "\\"
FIRST_BYTE_CODES = {"<": "l", "[": "b", "|": "p"}
UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
DECODED = {ESCAPE: ESCAPE, **{code: byte for byte, code in FIRST_BYTE_CODES.items()}}

PART_BYTES = 1 << 20
WHOLE_SEGMENT = 1 << 16       # bytes
PARTS = ddl("conv_id:long part:int n_turns:int formatted:string loss_starts:longs loss_ends:longs")
DIGEST = ddl("conv_id:long n_turns:long turns_sha256:string loss_chars:long loss_sha256:string formatted_chars:long")


def escape(texts: pa.Array) -> pa.Array:
    """Escaped texts, column at a time."""
    out = pc.replace_substring(texts, ESCAPE, ESCAPE * 2)
    for control in CONTROL_STRINGS:
        out = pc.replace_substring(out, control, ESCAPE + FIRST_BYTE_CODES[control[0]] + control[1:])
    return out


def unescape(text: str) -> str:
    return UNESCAPE.sub(lambda m: DECODED[m[1]], text) if ESCAPE in text else text


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets (one more than rows) and data bytes of a string column."""
    if column.offset:
        column = pa.concat_arrays([column])
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return starts, np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the given turns, each turn's start (one more than turns), and the text segments' bounds.

    ``begins`` marks turns that open a conversation.
    """
    n = len(begins)
    constants = [BEGIN.encode(), ROLE_OPEN.encode(), ROLE_CLOSE.encode(), TURN_CLOSE.encode()]
    role_starts, role_data = _buffers(roles)
    text_starts, text_data = _buffers(texts)
    fixed = np.frombuffer(b"".join(constants), dtype=np.uint8)
    at = np.concatenate([[0], np.cumsum([len(c) for c in constants])])
    # Segment sources in one pool: constants, then roles, then texts.
    pool = np.concatenate([fixed, role_data, text_data])
    role_base, text_base = len(fixed), len(fixed) + len(role_data)
    source = np.empty((n, 6), dtype=np.int64)
    length = np.empty((n, 6), dtype=np.int64)
    for column, k in ((0, 0), (1, 1), (3, 2), (5, 3)):
        source[:, column], length[:, column] = at[k], len(constants[k])
    length[:, 0] *= begins
    source[:, 2], length[:, 2] = role_starts[:-1] + role_base, np.diff(role_starts)
    source[:, 4], length[:, 4] = text_starts[:-1] + text_base, np.diff(text_starts)
    flat = length.ravel()
    ends = np.cumsum(flat)
    starts = ends - flat
    out = np.empty(int(ends[-1]) if n else 0, dtype=np.uint8)
    source = source.ravel()
    few = np.where(flat > WHOLE_SEGMENT, 0, flat)          # scattered byte by byte; larger segments are copied whole
    step = np.arange(int(few.sum())) - np.repeat(np.cumsum(few) - few, few)
    out[np.repeat(starts, few) + step] = pool[np.repeat(source, few) + step]
    for k in np.flatnonzero(flat > WHOLE_SEGMENT).tolist():
        out[starts[k]:ends[k]] = pool[source[k]:source[k] + flat[k]]
    turn_starts = np.concatenate([starts.reshape(n, 6)[:, 0], [len(out)]])
    text_bounds = np.stack([starts.reshape(n, 6)[:, 4], ends.reshape(n, 6)[:, 4]], axis=1)
    return out, turn_starts, text_bounds


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 ``data`` before each byte position ``at``."""
    cuts = np.unique(np.append(at, 0))
    leads = (data & 0xC0) != 0x80
    inside = cuts[cuts < len(data)]
    counts = np.add.reduceat(leads, inside, dtype=np.int64)
    before = np.append(0, np.cumsum(counts))
    return before[np.searchsorted(cuts, at)]


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about ``PART_BYTES`` of text; a longer text alone."""
    group = np.cumsum(sizes) // PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(PARTS)
    last: tuple | None = None          # (id,) of the conversation written last
    part = 0
    for batch in batches:
        sizes = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)
        for a, b in _slices(sizes):
            piece = batch.slice(a, b - a)
            ids = piece.column(0).to_pylist()
            new = np.array([i == 0 or ids[i] != ids[i - 1] for i in range(len(ids))])
            begins = new.copy()
            begins[0] = last != (ids[0],)
            roles, texts = piece.column(1), piece.column(2)
            out, turn_starts, bounds = assemble(escape(roles), escape(texts), begins)
            is_loss = pc.equal(roles, ASSISTANT).to_numpy(zero_copy_only=False).astype(bool)
            bounds = code_points(out, bounds)
            turn_points = code_points(out, turn_starts[:-1])
            first = np.flatnonzero(new)
            stop = np.append(first[1:], len(ids))
            formatted = pa.StringArray.from_buffers(
                len(first), pa.py_buffer(np.append(turn_starts[first], len(out)).astype(np.int32)), pa.py_buffer(out))
            parts, loss = [], []
            for x, y in zip(first.tolist(), stop.tolist()):
                part = part + 1 if last == (ids[x],) else 0
                last = (ids[x],)
                parts.append(part)
                spans = bounds[x:y][is_loss[x:y]] - turn_points[x]
                loss.append((spans[:, 0].tolist(), spans[:, 1].tolist()))
            yield from batches_of(schema, {
                "conv_id": [ids[x] for x in first.tolist()], "part": parts, "n_turns": (stop - first).tolist(),
                "formatted": formatted, "loss_starts": [s for s, _ in loss], "loss_ends": [e for _, e in loss],
            })


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per part of a conversation: formatted text, turns in it, and the spans under the loss mask.

    Parts of a conversation follow one another in their partition; their texts
    concatenated are the conversation's.
    """
    order: list[Column] = [F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")]
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), clean_text(role_col).alias("role"),
        clean_text(text_col).alias("text"), F.col(turn_col).cast("long").alias("turn"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions(*order)
    return ordered.mapInArrow(_format, PARTS)


def read_turns(formatted: str) -> Iterator[tuple[str, str, int]]:
    """Role, text and the start of the text segment of each turn, from formatted text alone."""
    at = len(BEGIN) if formatted.startswith(BEGIN) else 0
    while at < len(formatted):
        if not formatted.startswith(ROLE_OPEN, at):
            raise ValueError(f"no turn at {at}")
        mid = formatted.index(ROLE_CLOSE, at)
        start = mid + len(ROLE_CLOSE)
        end = formatted.index(TURN_CLOSE, start)
        yield unescape(formatted[at + len(ROLE_OPEN):mid]), unescape(formatted[start:end]), start
        at = end + len(TURN_CLOSE)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(DIGEST)
    names = [f.name for f in schema]
    state: list | None = None          # id, turns, their hash, loss characters, their hash, characters

    def result(s: list) -> tuple:
        return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

    for batch in batches:
        done = []
        for conv_id, part, _, formatted, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if part == 0:
                if state is not None:
                    done.append(result(state))
                state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text, _ in read_turns(formatted):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for a, b in zip(starts, ends):
                text = unescape(formatted[a:b])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
        yield from batches_of(schema, dict(zip(names, map(list, zip(*done)))) if done else {n: [] for n in names})
    if state is not None:
        yield from batches_of(schema, dict(zip(names, ([v] for v in result(state)))))


def chat_digest(parts: DataFrame) -> DataFrame:
    """One row per conversation, everything read back from the formatted parts in their order."""
    return parts.mapInArrow(_digest, DIGEST)
