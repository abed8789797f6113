"""Substring dedup: windows of words that appear anywhere else are removed.

Per bucket of `windows`, an FM-index of the segments' words: the Burrows-Wheeler
transform in a wavelet tree of packed bits, with the lengths shared by neighbours in
suffix order. All segments are streamed through it side by side, from their last word
back. Backward search keeps, for every place, the longest match (up to a window) that
stands at least twice in the index; where it reaches a window, the window repeats.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import IS_SPACE, U, WORD, with_fields, without, word_spans
from .windows import MANY, Windows, removed_windows


class WaveletTree:
    """Ranks in a sequence of small numbers: one row of packed bits per binary digit,
    from the highest; each level holds zeros before ones, in stable order."""

    def __init__(self, values: np.ndarray, digits: int):
        self.digits = digits
        self.bits, self.counts, self.zeros = [], [], []
        for d in range(digits - 1, -1, -1):
            bit = (values >> d & 1).astype(bool)
            packed = np.packbits(np.concatenate([bit, np.zeros(64 - len(bit) % 64, bool)]), bitorder="little").view("<u8")
            counts = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=counts[1:])
            self.bits.append(packed)
            self.counts.append(counts)
            self.zeros.append(len(bit) - int(counts[-1]))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place, but for a constant per symbol
        that `base` holds."""
        for k in range(self.digits):
            one = symbol >> (self.digits - 1 - k) & 1
            word, rest = at >> 6, (at & 63).astype(U)
            ones = self.counts[k][word] + np.bitwise_count(self.bits[k][word] & ((U(1) << rest) - U(1)))
            at = np.where(one == 1, self.zeros[k] + ones, at - ones)
        return at


class FMIndex:
    """Backward search over words numbered from 1, 0 between documents."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        self.depth = depth
        order = suffix_order(text, depth)
        last = text[order - 1]  # the word before each suffix, in suffix order
        self.digits = max(1, int(text.max()).bit_length())
        self.tree = WaveletTree(last, self.digits)
        symbols = np.arange(int(text.max()) + 1)
        self.first = np.searchsorted(np.sort(text), symbols)
        self.base = self.tree.rank(symbols, np.zeros(len(symbols), np.int64))
        # words shared with the suffix before, up to depth; -1 at both ends
        shared = np.zeros(n + 1, np.int32)
        alive = np.arange(1, n, dtype=np.int32)
        padded = np.concatenate([text, np.full(depth, -1, text.dtype)])
        for d in range(depth):
            a, b = padded[order[alive] + d], padded[order[alive - 1] + d]
            alive = alive[(a == b) & (a > 0)]
            if not len(alive):
                break
            shared[alive] = d + 1
        shared[0] = shared[n] = -1
        self.shared = shared
        place = np.arange(n + 1, dtype=np.int32)
        self.low, self.high = np.zeros(n + 1, np.int32), np.full(n + 1, n, np.int32)
        for d in np.unique(shared[1:n]).tolist():  # nearest place with a smaller value, on both sides
            less = shared < d
            at = np.flatnonzero(shared == d)
            self.low[at] = np.maximum.accumulate(np.where(less, place, np.int32(0)))[at]
            self.high[at] = np.minimum.accumulate(np.where(less, place, np.int32(n))[::-1])[::-1][at]

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = self.first[symbol] - self.base[symbol]
        return self.tree.rank(symbol, low) + shift, self.tree.rank(symbol, high) + shift

    def matching(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each place of the parts [begin, end) of `text`: the length (up to depth) of
        the longest string that begins there, ends in the part, and stands twice or more
        in the index."""
        n = len(self.shared) - 1
        found = np.zeros(len(text), np.int32)
        at = end - 1
        low, high, size = np.zeros(len(at), np.int64), np.full(len(at), n, np.int64), np.zeros(len(at), np.int32)
        begin = begin.copy()
        while len(at):
            down, up = self.extend(low, high, text[at])
            good = up - down >= 2
            go = good | (size == 0)
            # a longer match, or none even of this word alone: on to the word before
            low = np.where(good, down, low)
            high = np.where(good, up, high)
            size = size + good
            over = np.flatnonzero(size > self.depth)  # longer than a window: forget the last word
            if len(over):
                size[over] = self.depth
                low[over], high[over] = self._widen(low[over], high[over])
            found[at[go]] = size[go]
            at = at - go
            # no longer match: give up words at its end, down to what more places share
            cut = np.flatnonzero(~go)
            if len(cut):
                a, b = low[cut], high[cut]
                left, right = self.shared[a], self.shared[b]
                lead = np.where(left >= right, a, b)
                size[cut] = np.maximum(np.maximum(left, right), 0)
                low[cut], high[cut] = self.low[lead], self.high[lead]
                none = cut[size[cut] == 0]
                low[none], high[none] = 0, n
            live = at >= begin
            if not live.all():
                at, low, high, size, begin = at[live], low[live], high[live], size[live], begin[live]
        return found

    def _widen(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes that share `depth` words with those of the interval."""
        if not hasattr(self, "runs"):
            self.runs = np.flatnonzero(self.shared < self.depth)
        k = np.searchsorted(self.runs, low, side="right")
        return self.runs[k - 1], self.runs[k]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the next `depth` numbers, by doubling the sorted length."""
    n = len(text)
    rank = text.astype(np.int32)
    reach = 1
    while True:
        key = rank.astype(np.int64)
        key *= n + int(rank.max()) + 2
        if reach < n:
            key[:-reach] += rank[reach:]
            key[:-reach] += 1
        order = np.argsort(key, kind="stable").astype(np.int32)
        key = key[order]
        new = np.zeros(n, bool)
        new[1:] = key[1:] != key[:-1]
        del key
        rank[order] = np.cumsum(new, dtype=np.int32)
        reach *= 2
        if reach >= depth + 1 or rank.max() == n - 1:
            return order


def search(contents: list[np.ndarray], head: np.ndarray, w: Windows) -> list[np.ndarray]:
    """Which windows stand elsewhere too. Segments whose copies were removed already are
    in the index, but need no search."""
    _, numbers = np.unique(np.concatenate(contents), return_inverse=True)
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    of = np.repeat(np.arange(len(contents)), sizes)
    text = np.zeros(len(numbers) + len(contents) + 1, np.int32)  # a 0 before each segment and at the end
    text[np.arange(len(numbers)) + of + 1] = numbers + 1
    begins = np.cumsum(sizes + 1) - sizes
    index = FMIndex(text, w.length)
    ask = np.flatnonzero(head["flags"] & MANY == 0)
    length = index.matching(text, begins[ask], begins[ask] + sizes[ask])
    return [length[b:b + n] >= w.length for b, n in zip(begins.tolist(), head["n"].tolist())]


def cut_words(text: bytes, spans: np.ndarray) -> bytes:
    """The text without the words of the spans and the white space after each of them."""
    if not len(spans):
        return text
    starts, _ = word_spans(np.frombuffer(text, np.uint8))
    edges = [0]
    for a, b in spans.tolist():
        edges += [int(starts[a]), int(starts[b]) if b < len(starts) else len(text)]
    edges.append(len(text))
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35,
                          words_col: str = "n_words", spans_col: str = "spans", kept_col: str = "kept", **limits) -> DataFrame:
    """`docs` with, for each row, n_words, `spans` (first word, word after the last, … of
    what is removed) and `kept`, the text without those words and the white space after
    each.

    A word is removed if a window of `length` words in a row that covers it also begins
    anywhere else, in this or another document; all copies go. Windows are judged on
    the input. Words are runs of characters other than space and the ASCII controls 9
    to 13, compared as they are (by 64-bit hashes, 35 in a row).

    Nulls: a null text has no words. Repeated rows hold each other's windows, so all of
    them lose every word if they have a window. Empty table: no rows. Columns of `docs`
    called like the new ones are replaced.
    """
    w = Windows("word", length, min(8, length), first_stays=False, **{"longest": 128, **limits})
    docs = without(docs, words_col, spans_col, kept_col)
    schema = with_fields(docs, f"`{words_col}` bigint, `{spans_col}` array<int>, `{kept_col}` string")

    def finish(batch, texts, found):
        sizes = [int(np.count_nonzero(np.diff((~IS_SPACE[np.frombuffer(t, np.uint8)]).astype(np.int8), prepend=0) == 1))
                 for t in texts]
        return pa.record_batch(
            [*batch.columns, pa.array(sizes, pa.int64()),
             pa.array([s.ravel().tolist() for s in found], pa.list_(pa.int32())),
             pa.array([cut_words(t, s) for t, s in zip(texts, found)], pa.binary()).cast(pa.string())],
            names=[*batch.schema.names, words_col, spans_col, kept_col])

    return removed_windows(docs, id_col, text_col, w, search, finish, schema)


def words_joined(text: Column) -> Column:
    """The words of a text, one space between."""
    return F.array_join(F.regexp_extract_all(text, F.lit(f"({WORD})")), " ")


def plain_words(text: str | None) -> list[str]:
    return re.findall(WORD, text or "")
