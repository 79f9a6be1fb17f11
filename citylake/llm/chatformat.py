"""Chat formatting by columnar byte assembly.

A turn becomes `### role: text</turn>` and a line end. Inside roles and texts a backslash
and the characters that open a control string are written as two-byte escapes, so neither
`#` nor `<` occurs in content and the markers can be found again. For a batch of turns all
segment lengths are known first; their running sums give every byte its place in one
preallocated buffer, into which headers and contents are scattered, and which becomes the
Arrow string column as it is.

Cases. Null role or text: empty. Null turn numbers come first, ties are ordered by role
and text; repeated rows are repeated turns. Rows with a null conv_id form one
conversation. An empty table gives no rows. A conversation longer than `part_bytes` is
written in parts (0, 1, ...), each of whole turns, so memory stays bounded. Other columns
are ignored.
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

OPEN, MIDDLE, CLOSE = b"### ", b": ", b"</turn>\n"
ESCAPES = {0x5C: b"\\", 0x23: b"h", 0x3C: b"l", 0x3A: b"c"}  # backslash # < and, in roles, :
PART_BYTES = 32 << 20

SCHEMA = (
    "conv_id long, part int, n_turns long, formatted string, "
    "loss_start array<int>, loss_length array<int>"
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def _table(characters: bytes) -> np.ndarray:
    codes = np.zeros(256, np.uint8)
    for c in characters:
        codes[c] = ESCAPES[c][0]
    return codes


TEXT_CODES, ROLE_CODES = _table(b"\\#<"), _table(b"\\#<:")
NAMES = {code[0]: bytes([c]) for c, code in ESCAPES.items()}


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, and the length of each value."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, np.diff(offsets)


def escaped(data: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and lengths after escaping: one more byte for every code."""
    code = codes[data]
    hit = code > 0
    shift = np.cumsum(hit)
    out = np.empty(len(data) + int(shift[-1] if len(shift) else 0), np.uint8)
    place = np.arange(len(data)) + shift
    out[place] = np.where(hit, code, data)
    out[place[hit] - 1] = 0x5C
    ends = np.cumsum(lengths)
    upto = np.concatenate(([0], shift))
    return out, lengths + upto[ends] - upto[ends - lengths]


def scatter(out: np.ndarray, starts: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> None:
    """Copy run i of `data` to out[starts[i]:]."""
    shift = starts - (np.cumsum(lengths) - lengths)
    out[np.repeat(shift, lengths) + np.arange(len(data))] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer of all turns, their starts and end, and start and length of the contents."""
    role, role_size = escaped(*raw_bytes(pc.fill_null(roles, "")), ROLE_CODES)
    text, text_size = escaped(*raw_bytes(pc.fill_null(texts, "")), TEXT_CODES)
    sizes = len(OPEN) + role_size + len(MIDDLE) + text_size + len(CLOSE)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    buffer = pa.allocate_buffer(int(edges[-1]))
    out = np.frombuffer(buffer, np.uint8)
    content = edges[:-1] + len(OPEN) + role_size + len(MIDDLE)
    for marker, starts in (
        (OPEN, edges[:-1]),
        (MIDDLE, content - len(MIDDLE)),
        (CLOSE, edges[1:] - len(CLOSE)),
    ):
        for k, byte in enumerate(marker):
            out[starts + k] = byte
    scatter(out, edges[:-1] + len(OPEN), role, role_size)
    scatter(out, content, text, text_size)
    return buffer, edges, content, text_size


def format_conversations(
    turns: DataFrame, trained_role: str = "assistant", part_bytes: int = PART_BYTES
) -> DataFrame:
    """One row per conversation (or part of a very long one) from rows
    (conv_id, turn, role, text): the formatted string and the byte spans under the loss
    mask, which are the contents of `trained_role`.

    Turns are sorted within their partition and streamed, so no conversation is
    collected; rows of one conversation leave in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = object(), 0
        for rows, whole in _conversations(batches, part_bytes):
            ids = rows.column("conv_id")
            values = ids.to_pylist()
            firsts = [0] + [i for i in range(1, len(values)) if values[i] != values[i - 1]]
            buffer, edges, content, size = assemble(rows.column("role"), rows.column("text"))
            trained = pc.fill_null(pc.equal(rows.column("role"), trained_role), False)
            trained = trained.to_numpy(zero_copy_only=False)
            bounds = [*firsts, len(values)]
            parts, starts, spans = [], [], []
            for i, j in zip(bounds, bounds[1:], strict=False):
                part = part + 1 if values[i] == last else 0
                last = values[i]
                parts.append(part)
                at = np.arange(i, j)[trained[i:j]]
                starts.append((content[at] - edges[i]).astype(np.int32))
                spans.append(size[at].astype(np.int32))
            if whole:
                last = object()
            offsets = edges[bounds].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(firsts)),
                    pa.array(parts, pa.int32()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.StringArray.from_buffers(len(firsts), pa.py_buffer(offsets), buffer),
                    pa.array(starts, pa.list_(pa.int32())),
                    pa.array(spans, pa.list_(pa.int32())),
                ],
                ["conv_id", "part", "n_turns", "formatted", "loss_start", "loss_length"],
            )

    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.col("role").cast("string"),
        F.col("text").cast("string"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(run, SCHEMA)


def _conversations(
    batches: Iterator[pa.RecordBatch], part_bytes: int
) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Runs of rows that end with a whole conversation, or after `part_bytes` of one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        marks = np.cumsum(size, dtype=np.int64) // part_bytes
        cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if i == j:
                continue
            held.append(batch.slice(i, j - i))
            rows = _joined(held)
            ids = rows.column("conv_id").to_pylist()
            k = next((k for k in range(len(ids) - 1, 0, -1) if ids[k] != ids[k - 1]), 0)
            if k:
                yield rows.slice(0, k), True
            rest = rows.slice(k)
            if rest.nbytes > part_bytes:
                yield rest, False
                held = []
            else:
                held = [rest]
    if held:
        yield _joined(held), True


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def unescape(data: bytes) -> bytes:
    return re.sub(rb"\\(.)", lambda m: NAMES[m[1][0]], data) if b"\\" in data else data


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """The (role, text) turns of a formatted string."""
    turns = []
    for segment in formatted.split(CLOSE)[:-1]:
        role, _, text = segment[len(OPEN) :].partition(MIDDLE)
        turns.append((unescape(role), unescape(text)))
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, read from its formatted parts in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if state is not None and row["part"] == 0:
                    done.append(_finished(state))
                    state = None
                if state is None:
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                data = row["formatted"].encode()
                for role, text in parse(data):
                    state[1] += 1
                    state[2].update(role + b"\n" + text + b"\n")
                for start, length in zip(row["loss_start"], row["loss_length"], strict=True):
                    text = unescape(data[start : start + length])
                    state[3] += len(text.decode())
                    state[4].update(text)
                state[5] += len(row["formatted"])
            yield _digests(done)
        if state is not None:
            yield _digests([_finished(state)])

    return formatted.mapInArrow(run, DIGESTS)


def _finished(state: list) -> tuple:
    conv, turns, turn_hash, chars, loss_hash, total = state
    return conv, turns, turn_hash.hexdigest(), chars, loss_hash.hexdigest(), total


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [field.split()[0] for field in DIGESTS.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
