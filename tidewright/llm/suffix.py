"""Suffix-array dedup: byte strings of a fixed length that appear earlier are cut out.

Per bucket of `windows`, a suffix array of the segments' bytes is built by two-stage
sorting: only suffixes smaller than their successor are sorted directly, all others
are put in place by scanning the buckets of first bytes in order. Neighbours in the
array whose common prefix reaches the window length are repeats of each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import with_fields, without
from .windows import Windows, removed_windows


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix, whether it is smaller than the one that begins a byte later.
    Among equal bytes in a row, the byte after them decides; the last suffix is larger."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    up = np.append(text[change] < text[change + 1], False)
    return up[np.searchsorted(change, np.arange(n))]


def direct_sort(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the `depth` bytes that follow, eight at a time; only
    ties go into the next round. `text` must reach depth + 8 bytes past every position."""
    keys = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
    key = keys[at].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.ones(len(at), bool)
    new[1:] = key[1:] != key[:-1]
    for d in range(8, depth, 8):
        tied = ~new
        tied[:-1] |= ~new[1:]
        tied = np.flatnonzero(tied)
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        part = at[tied]
        key = keys[part + d].astype(np.uint64)
        order = np.lexsort((key, group))
        part, key = part[order], key[order]
        at[tied] = part
        new[tied[1:]] |= key[1:] != key[:-1]
    return at


def two_stage(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions (a mask) in suffix order, to at least `depth` bytes.

    Suffixes smaller than their successor are sorted directly. Every other one is
    larger than or equal to its successor, so scanning the order from the smallest up
    and putting each suffix's predecessor next in its bucket puts it in place.
    """
    n = len(text)
    small = smaller_than_next(text)
    # a suffix put in place by a scan needs the chain of its successors up to a sorted one
    stop = np.minimum.accumulate(np.where(small, np.arange(n), n - 1)[::-1])[::-1]
    cover = np.zeros(n + 1, np.int64)
    ask = np.flatnonzero(wanted)
    np.add.at(cover, ask, 1)
    np.add.at(cover, stop[ask] + 1, -1)
    needed = np.cumsum(cover[:n]) > 0
    start = np.flatnonzero(needed & small)
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    directly = direct_sort(padded, start, depth)
    first = text[directly]
    edges = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed[n - 1] and not small[n - 1]:  # the last suffix follows nothing
        induced[text[n - 1]].append(np.array([n - 1]))

    def scan(part: np.ndarray, byte: int) -> np.ndarray:
        """Predecessors of `part` put into their buckets; those of this bucket are returned."""
        before = part[part > 0] - 1
        before = before[needed[before] & ~small[before]]
        own = text[before] == byte
        later = before[~own]
        if len(later):
            to = text[later]
            order = np.argsort(to, kind="stable")
            later, to = later[order], to[order]
            at = np.append(np.flatnonzero(np.diff(to.astype(np.int16), prepend=-1)), len(to))
            for a, b in zip(at[:-1], at[1:]):
                induced[to[a]].append(later[a:b])
        return before[own]

    found = []
    for byte in range(256):
        wave = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, np.int64)
        induced[byte] = []
        while len(wave):
            found.append(wave)
            wave = scan(wave, byte)
        part = directly[edges[byte]:edges[byte + 1]]
        found.append(part)
        scan(part, byte)
    order = np.concatenate(found)
    return order[wanted[order]]


def common_prefix_reaches(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place but the first in the order, whether it shares `length` bytes with
    the place before; compared eight bytes at a time while still equal."""
    words = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    alive = np.arange(1, len(order))
    for d in sorted({*range(0, length - 7, 8), length - 8}):
        alive = alive[words[order[alive] + d] == words[order[alive - 1] + d]]
    found = np.zeros(len(order), bool)
    found[alive] = True
    return found


def search(contents: list[np.ndarray], head: np.ndarray, w: Windows) -> list[np.ndarray]:
    """Which windows also begin earlier. Segments come in document order, so the place
    in the joined text is the order of the windows."""
    text = np.concatenate(contents)
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    begins = np.cumsum(sizes) - sizes
    edge = np.zeros(len(text) + 1, np.int64)
    edge[begins] += 1
    np.add.at(edge, begins + head["n"], -1)
    valid = np.cumsum(edge[:-1]) > 0
    order = two_stage(text, valid, w.length)
    new = ~common_prefix_reaches(text, order, w.length)
    group = np.flatnonzero(new)
    lowest = np.minimum.reduceat(order, group)
    again = np.ones(len(text), bool)
    again[lowest] = False
    return [again[b:b + n] for b, n in zip(begins.tolist(), head["n"].tolist())]


def cut_bytes(text: bytes, spans: np.ndarray) -> bytes:
    if not len(spans):
        return text
    edges = [0, *spans.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                          **limits) -> DataFrame:
    """`docs` with, for each row, n_bytes, `spans` (begin, end, begin, end, … of the
    bytes cut out) and `kept`, the other bytes joined (binary, since a cut may part a
    character).

    A byte is cut out if a string of `length` bytes that covers it also begins
    earlier: in a document with a smaller id, or earlier in the same one. Strings
    never cross documents and are judged on the input.

    Nulls: a null text is empty; a null id is above all others. Same id, other text:
    ordered by a hash of the text. Repeated rows: one stays, the others are cut whole
    if they have `length` bytes. Empty table: no rows. Columns of `docs` called like
    the new ones are replaced.
    """
    w = Windows("byte", length, min(32, length), first_stays=True, **limits)
    docs = without(docs, "n_bytes", "spans", "kept")
    schema = with_fields(docs, "n_bytes bigint, spans array<int>, kept binary")

    def finish(batch, texts, found):
        return pa.record_batch(
            [*batch.columns, pa.array([len(t) for t in texts], pa.int64()),
             pa.array([s.ravel().tolist() for s in found], pa.list_(pa.int32())),
             pa.array([cut_bytes(t, s) for t, s in zip(texts, found)], pa.binary())],
            names=[*batch.schema.names, "n_bytes", "spans", "kept"])

    return removed_windows(docs, id_col, text_col, w, search, finish, schema)
