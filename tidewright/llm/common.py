"""Helpers shared by the text operators: words, batches, blobs dealt to buckets."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidewright.session import cut_lineage, scratch  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
U = np.uint64
# One odd factor per place of a word, and its inverse modulo 2^64
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

PIECES = "bucket int, kind int, blob binary"
PIECES_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without columns called like the ones an operator adds (upper or lower case)."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


def ship(df: DataFrame) -> None:
    """Sends this package's code to the Python workers, which need not have it installed."""
    context = df.sparkSession.sparkContext
    if getattr(context, "_tidewright_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidewright-code-"), "tidewright_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    context._tidewright_shipped = True


def with_fields(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of `df` with more columns."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


# What workers remember from task to task: functools caches, each of one operator
REMEMBERED: list[Callable] = []


def begin(own: Callable | None = None) -> None:
    """At the start of a task: gives back what this worker, which Spark uses again and again,
    still holds from tasks of other operators. `own` is what goes on being used."""
    others = [c for c in REMEMBERED if c is not own and c.cache_info().currsize]
    for c in others:
        c.cache_clear()
    if others:
        gc.collect()
    pa.default_memory_pool().release_unused()


def slices(batches: Iterable[pa.RecordBatch], column: str, budget: int, own: Callable | None = None) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about `budget` bytes of `column`, or one row. A task
    begins here; `own` is what it remembers from others (`begin`)."""
    begin(own)
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // budget
        at = np.append(np.flatnonzero(np.diff(part, prepend=-1)), batch.num_rows)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield batch.slice(a, b - a)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; one to one."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}


def _power(which: str, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        factors = np.full(n, BASE if which == "up" else BASE_INVERSE, U)
        factors[0] = 1
        _powers[which] = np.cumprod(factors)
    return _powers[which][:n]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends in an array of bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit hash of each word, alike wherever the word stands; blocks bound the memory."""
    found = np.empty(len(starts), U)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + block)))
        base, top = int(starts[a]), int(ends[b - 1])
        sums = np.zeros(top - base + 1, U)
        np.cumsum((data[base:top].astype(U) + U(1)) * _power("up", top - base), out=sums[1:])
        s, e = starts[a:b] - base, ends[a:b] - base
        found[a:b] = (sums[e] - sums[s]) * _power("down", top - base)[s] + (e - s).astype(U)
        a = b
    return mixed(found)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in one array of bytes, a space after each; begin and end of each."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    return np.frombuffer(b" ".join(texts) + b" ", np.uint8), ends - sizes, ends


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in turn, and how many words each text has."""
    data, begins, _ = joined(texts)
    starts, ends = word_spans(data)
    counts = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    return word_hashes(data, starts, ends), counts


def text_key(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) & 0xFFFFFFFF


def dealt(kind: int, buckets: np.ndarray, records: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per bucket with the records that belong there."""
    if not len(records):
        return
    order = np.argsort(buckets, kind="stable")
    buckets, records = buckets[order], records[order]
    at = np.append(np.flatnonzero(np.diff(buckets, prepend=-1)), len(buckets))
    yield pieces((int(buckets[a]), kind, records[a:b].tobytes()) for a, b in zip(at[:-1], at[1:]))


def pieces(rows: Iterable[tuple[int, int, bytes]]) -> pa.RecordBatch:
    buckets, kinds, blobs = zip(*rows)
    return pa.record_batch([pa.array(buckets, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())],
                           schema=PIECES_ARROW)


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, bytes]]]]:
    """The (kind, blob) rows of each bucket, from rows sorted by bucket. A task begins here."""
    begin()

    def rows():
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                yield row

    for bucket, group in groupby(rows(), key=lambda r: r[0]):
        yield bucket, ((kind, blob) for _, kind, blob in group)


def by_bucket(df: DataFrame) -> DataFrame:
    return df.repartition("bucket").sortWithinPartitions("bucket", "kind")


def packed(batch: pa.RecordBatch) -> bytes:
    """A batch as compressed Arrow bytes, to carry whole rows through an exchange."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(blob).read_all().combine_chunks()
    return table.to_batches()[0]
