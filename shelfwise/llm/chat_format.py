"""Chat formatting by columnar byte assembly.

Each turn becomes ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``.  Segment lengths and
cumulative offsets of a whole run of rows are computed in numpy, and headers
and contents are scattered from the Arrow buffers into one preallocated output
buffer, whose conversation boundaries are the offsets of the output column.

Control strings inside texts are broken by a backslash after their first
character and backslashes are doubled, so dropping each backslash that comes
before another character gives back the text exactly.  Role names escape
newlines as ``\\n`` as well.

Rows are shuffled and sorted by (conversation, turn) and streamed: a
conversation too long for one run of rows comes out in several parts, numbered
from 0 and in order, so no conversation is ever held whole.

Cases: null role or text is empty; null conversation ids form one
conversation, first in order; null turns come first; equal turns go by role,
then text; repeated rows are repeated turns; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches

START, END = "<|im_start|>", "<|im_end|>\n"
# Control strings of this and other public chat templates.
CONTROL = ["<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
# bytes of text assembled at a time (a longer single text is assembled alone)
RUN_BYTES = 4_000_000

_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END), re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(values: pa.Array) -> pa.Array:
    out = pc.replace_substring(values, "\\", "\\\\")
    for c in CONTROL:
        out = pc.replace_substring(out, c, c[0] + "\\" + c[1:])
    return out


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(values: pa.Array) -> pa.Array:
    return pc.replace_substring(escape(values), "\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def _buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array without nulls."""
    values = values.cast(pa.large_string())
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    return at, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def _scatter(out: np.ndarray, to: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> None:
    """Copy each segment data[offsets[i]:offsets[i+1]] to out[to[i]:]."""
    lengths = np.diff(offsets)
    shift = np.repeat(to - (offsets[:-1] - offsets[0]), lengths)
    out[shift + np.arange(len(shift))] = data[offsets[0]:offsets[-1]]


def _constant(value: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.arange(n + 1, dtype=np.int64) * len(value), np.tile(np.frombuffer(value, np.uint8), n)


def assemble(roles: pa.Array, texts: pa.Array, first: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted text of each conversation of a run of rows.

    ``first``: index of each conversation's first row.  Also returns, per row,
    the start and end of its escaped text in code points of its conversation.
    """
    n = len(roles)
    role, text = escape_role(roles), escape(texts)
    segments = [_constant(START.encode(), n), _buffers(role), _constant(b"\n", n), _buffers(text),
                _constant(END.encode(), n)]
    lengths = np.stack([np.diff(at) for at, _ in segments], axis=1)          # rows x segments
    begins = np.concatenate([[0], np.cumsum(lengths.ravel())])
    out = np.empty(begins[-1], np.uint8)
    for k, (at, data) in enumerate(segments):
        _scatter(out, begins[k:-1:len(segments)], at, data)
    bounds = np.append(begins[:-1:len(segments)][first], begins[-1]).astype(np.int64)
    formatted = pa.Array.from_buffers(pa.large_string(), len(first),
                                      [None, pa.py_buffer(bounds), pa.py_buffer(out)])
    chars = lengths.copy()
    chars[:, 1] = pc.utf8_length(role).to_numpy(zero_copy_only=False)
    chars[:, 3] = pc.utf8_length(text).to_numpy(zero_copy_only=False)
    row_start = np.concatenate([[0], np.cumsum(chars.sum(axis=1))])[:-1]
    origin = np.repeat(row_start[first], np.diff(np.append(first, n)))
    start = row_start - origin + chars[:, :3].sum(axis=1)
    return formatted, start, start + chars[:, 3]


def _runs(b: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about RUN_BYTES of text each."""
    size = pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
    total, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + RUN_BYTES, "right"))
        hi = max(hi, lo + 1)
        yield lo, hi
        lo = hi


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", *,
                         loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss): ``loss`` lists the [start, end) spans, in code
    points of ``formatted``, that a loss counts: the escaped texts of ``loss_roles``.

    Partitioned by conversation and ordered by (conv_id, part) in each partition.
    """
    def assembled(batches):
        last, part = (), 0
        for b in batches:
            for lo, hi in _runs(b):
                run = b.slice(lo, hi - lo)
                ids = run.column(0).to_pylist()
                first = np.array([i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]], np.int64)
                roles = pc.fill_null(run.column(1), "")
                text, start, end = assemble(roles, pc.fill_null(run.column(2), ""), first)
                in_loss = pc.is_in(roles, pa.array(loss_roles)).to_numpy(zero_copy_only=False)
                parts, turns, spans = [], [], []
                for f, t in zip(first, np.append(first[1:], len(ids))):
                    part = part + 1 if (ids[f],) == last else 0
                    last = (ids[f],)
                    parts.append(part)
                    turns.append(t - f)
                    spans.append([{"start": start[i], "end": end[i]} for i in range(f, t) if in_loss[i]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[f] for f in first], pa.int64()), pa.array(parts, pa.int32()),
                     pa.array(turns, pa.int64()), text.cast(pa.string()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    names=["conv", "part", "n_turns", "formatted", "loss"])

    keyed = rows.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                        F.col(role_col).cast("string").alias("role"),
                        F.col(text_col).cast("string").alias("text"))
    ordered = keyed.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return short_batches(ordered.select("conv", "role", "text")).mapInArrow(
        assembled, "conv long, part int, n_turns long, formatted string, loss array<struct<start:long,end:long>>"
    ).withColumnRenamed("conv", conv_col)


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, read back from formatted text."""
    for m in _TURN.finditer(formatted):
        yield unescape_role(m[1]), unescape(m[2])


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests per conversation, read from the output of ``format_conversations`` (in its order)."""
    def digests(batches):
        def row():
            return (conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

        seen, out = False, []
        conv = n_turns = loss_chars = chars = turns = loss = None
        for b in batches:
            for conv_id, part, text, spans in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if part == 0:
                    if seen:
                        out.append(row())
                    seen, conv, n_turns, loss_chars, chars = True, conv_id, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, content in parse_turns(text):
                    turns.update(f"{role}\n{content}\n".encode())
                    n_turns += 1
                for s in spans:
                    content = unescape(text[s["start"]:s["end"]])
                    loss.update(content.encode())
                    loss_chars += len(content)
                chars += len(text)
            yield _digest_batch(out)
            out = []
        if seen:
            yield _digest_batch([row()])

    return formatted.select(conv_col, "part", "n_turns", "formatted", "loss").mapInArrow(
        digests, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long").withColumnRenamed("conv", conv_col)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 6
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                      names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                             "formatted_chars"])
