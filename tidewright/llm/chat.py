"""Chat formatting by columnar byte assembly.

A batch of turns becomes formatted text in one step: lengths of all segments (header,
content, closing), cumulative offsets from them, and one scatter of all bytes into a
preallocated Arrow buffer. Turns are formatted on their own, so a conversation of any
length may lie in many batches and tasks; nothing gathers it.

Template: `<s>role\\n` + escaped text + `</s>` for each turn. Inside roles and texts,
`&` becomes `&amp;` and `<` becomes `&lt;`, and a line end in a role `&#10;`, so no control string
can come from a text and the text comes back whole. The loss mask covers the text of assistant turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import ship, slices

OPEN, BREAK, CLOSE = b"<s>", b"\n", b"</s>"


def escaped(column: pa.Array) -> pa.Array:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;")):
        column = pc.replace_substring(column, plain, safe)
    return column


def plain(text: str) -> str:
    return text.replace("&lt;", "<").replace("&#10;", "\n").replace("&amp;", "&")


def assemble(segments: list[pa.Array | bytes], rows: int) -> tuple[pa.Array, np.ndarray]:
    """Each row's segments joined, and where each begins in its row's bytes (rows, segments).
    A segment is a constant or a string array without nulls."""
    lengths = np.empty((rows, len(segments)), np.int64)
    for k, s in enumerate(segments):
        lengths[:, k] = len(s) if isinstance(s, bytes) else pc.binary_length(s).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    begins = ends - lengths
    total = int(ends[-1, -1]) if rows else 0
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, np.uint8)
    for k, s in enumerate(segments):
        if isinstance(s, bytes):
            for j, byte in enumerate(s):
                out[begins[:, k] + j] = byte
            continue
        first = s.offset
        offsets = np.frombuffer(s.buffers()[1], np.int32)[first:first + rows + 1].astype(np.int64)
        data = np.frombuffer(s.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        to = np.arange(len(data)) + np.repeat(begins[:, k] - (offsets[:-1] - offsets[0]), lengths[:, k])
        out[to] = data
    offsets = np.concatenate([[0], ends[:, -1]]).astype(np.int32)
    text = pa.StringArray.from_buffers(rows, pa.py_buffer(offsets), buffer)
    return text, begins - (ends[:, -1] - lengths.sum(1))[:, None]


def format_turns(batch: pa.RecordBatch, role_col: str, text_col: str, trained: str) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Formatted text of each turn, and the bytes of it under the loss mask (begin, end;
    equal where there are none)."""
    roles = pc.fill_null(batch.column(role_col).cast(pa.string()), "")
    texts = pc.fill_null(batch.column(text_col).cast(pa.string()), "")
    safe = pc.replace_substring(escaped(roles), "\n", "&#10;")
    text, begins = assemble([OPEN, safe, BREAK, escaped(texts), CLOSE], batch.num_rows)
    learn = pc.equal(roles, trained).to_numpy(zero_copy_only=False)
    low = np.where(learn, begins[:, 3], 0)
    high = np.where(learn, begins[:, 4], 0)
    return text, pa.array(low, pa.int64()), pa.array(high, pa.int64())


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", trained: str = "assistant", chunk_bytes: int = 4 << 20) -> DataFrame:
    """(conv_id, turn, place, formatted, loss_begin, loss_end): one row per turn, laid out
    in order of conversation and turn; the formatted conversation is its rows' text put
    together. The mask counts bytes of the row.

    Rows are dealt by ranges of (conversation, turn), so a conversation that holds a
    third of all rows spreads over many tasks. `place` breaks ties of one turn: rows of
    one turn are ordered by their formatted text when read back.

    Nulls: a null text or role is empty; a null turn comes first; null conversations are
    one conversation. Empty table: no rows. Extra columns are not read.
    """
    ship(turns)
    rows = turns.select(F.col(f"`{conv_col}`").cast("bigint").alias("conv_id"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
                        F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("text"))
    placed = (rows.withColumn("place", F.xxhash64("role", "text"))
              .repartitionByRange("conv_id", "turn", "place").sortWithinPartitions("conv_id", "turn", "place"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", chunk_bytes):
            text, low, high = format_turns(batch, "role", "text", trained)
            yield pa.record_batch([batch.column("conv_id"), batch.column("turn"), batch.column("place"), text, low, high],
                                  names=["conv_id", "turn", "place", "formatted", "loss_begin", "loss_end"])

    return placed.mapInArrow(run, "conv_id bigint, turn bigint, place bigint, formatted string, loss_begin bigint, loss_end bigint")


def read_turns(batch: pa.RecordBatch) -> Iterator[tuple[str, str, str]]:
    """Role, text and trained text of each turn, from its formatted text and mask alone."""
    for formatted, low, high in zip(*(batch.column(c).to_pylist() for c in ("formatted", "loss_begin", "loss_end"))):
        if not (formatted.startswith("<s>") and formatted.endswith("</s>")):
            raise ValueError(f"not a formatted turn: {formatted[:40]!r}")
        role, _, text = formatted[3:-4].partition("\n")
        yield plain(role), plain(text), plain(formatted.encode()[low:high].decode()) if high > low else ""


def digest_chat(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted rows: n_turns, turns_sha256 (role, line
    end, text, line end of each turn), loss_chars, loss_sha256 (the trained text, joined)
    and formatted_chars. A digest depends on all turns in order, so each conversation's
    rows pass one task, as a stream: only the running digests are kept.
    """
    ship(formatted)
    schema = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
              "formatted_chars bigint")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        done: list[tuple] = []

        def close() -> None:
            done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            sizes = pc.utf8_length(batch.column("formatted")).to_pylist()
            for c, (role, text, loss), size in zip(batch.column("conv_id").to_pylist(), read_turns(batch), sizes):
                if state is None or c != conv:
                    if state is not None:
                        close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += size
            if done:
                yield pa.record_batch([pa.array(c, pa.string() if "sha" in n else pa.int64()) for n, c in zip(names, zip(*done))], names=names)
                done = []
        if state is not None:
            close()
            yield pa.record_batch([pa.array(c, pa.string() if "sha" in n else pa.int64()) for n, c in zip(names, zip(*done))], names=names)

    order = ["conv_id", "turn", "formatted"]
    return formatted.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, schema)
