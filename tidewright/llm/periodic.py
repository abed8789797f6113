"""Runs: stretches of words that repeat with a period, found by longest common extensions.

How far two places of a text run on alike, in either direction, is asked of an index over
a difference cover: of every 21 places only five are sampled and their suffixes sorted;
any two places meet two samples after the same step of under 21 words, so a question
compares those few words and takes the rest as the least common prefix between two ranks
(sparse table). A run of period q and exponent e holds (e-1)*q pairs of equal words q
apart in a row, so a grid of that spacing meets it; the grids of all periods together are
harmonic, n log n points, of which only those with equal words around are asked about.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import IS_SPACE, joined, ship, slices, text_bytes, with_fields, without, word_spans

EVERY = 21  # words of which a difference cover samples five
GRID = 1 << 20  # points of the grids looked at side by side


@cache
def difference_cover(every: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest set of residues whose differences are all residues, and for each
    difference d a member x such that x + d is one too."""
    for size in count(1):
        for rest in combinations(range(1, every), size - 1):
            chosen = (0, *rest)
            member = {(b - a) % every: a for a in chosen for b in chosen}
            if len(member) == every:
                return np.array(chosen), np.array([member[d] for d in range(every)])
    raise AssertionError


class Extensions:
    """Longest common extensions to the right, within parts of `words` that end in a word
    of their own (a terminator, which nothing else equals)."""

    def __init__(self, words: np.ndarray, part: np.ndarray, every: int = EVERY):
        self.every, n = every, len(words)
        residues, self.member = difference_cover(every)
        self.words = np.append(words, np.zeros(every, words.dtype))
        self.size = len(residues)
        self.place = np.full(every, -1)
        self.place[residues] = np.arange(self.size)
        at = (np.arange(0, n + every, every)[:, None] + residues).ravel()
        self.at = at[at < n]
        self._sort(part[self.at])

    def _sort(self, part: np.ndarray) -> None:
        """Order of the sampled suffixes within their parts, by words and then by doubling;
        what is unique already is not touched again."""
        m = len(self.at)
        order, first = np.arange(m), np.diff(part, prepend=-1) != 0
        low, high = int(self.words.min()), int(self.words.max()) + 1
        per_key = max(1, 62 // max(1, (high - low).bit_length()))

        def refine(key) -> bool:
            lone = first & np.append(first[1:], True)
            rows = np.flatnonzero(~lone)
            if not len(rows):
                return False
            group = np.cumsum(first)[rows]
            keys = key(order[rows])
            by = np.lexsort((keys, group))
            order[rows], keys = order[rows][by], keys[by]
            first[rows[1:]] |= keys[1:] != keys[:-1]
            return True

        def named() -> np.ndarray:
            names = np.empty(m, np.int32)
            names[order] = np.cumsum(first)
            return names

        for k in range(0, self.every, per_key):
            def block(rows: np.ndarray, k=k) -> np.ndarray:
                key = np.zeros(len(rows), np.int64)
                for j in range(k, min(k + per_key, self.every)):
                    key = key * (high - low) + (self.words[self.at[rows] + j] - low)
                return key
            if not refine(block):
                break
        levels = [named()]
        while True:
            step, names = self.size << (len(levels) - 1), levels[-1]
            if not refine(lambda rows: names[rows + step]):
                break
            levels.append(named())
        self.rank = np.empty(m, np.int32)
        self.rank[order] = np.arange(m, dtype=np.int32)
        self._prefixes(order, part, levels)

    def _prefixes(self, order: np.ndarray, part: np.ndarray, levels: list[np.ndarray]) -> None:
        """Words that neighbours in the order share, and the sparse table of their minima."""
        m = len(order)
        shared = np.zeros(m, np.int32)
        rows = np.flatnonzero(part[order[1:]] == part[order[:-1]]) + 1
        a, b = order[rows - 1], order[rows]
        found = np.zeros(len(rows), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            # equal blocks hold no terminator, so what follows them is there
            same = levels[k][a] == levels[k][b]
            found[same] += self.every << k
            a, b = a + same * (self.size << k), b + same * (self.size << k)
        shared[rows] = found + self._compare(self.at[a], self.at[b], np.full(len(rows), self.every))
        self.least = [shared]
        while 1 << len(self.least) <= m:
            half, last = 1 << (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(last[:-half], last[half:]))

    def _compare(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many words are equal from a and b on, up to a limit of at most `every`."""
        found = np.zeros(len(a), np.int64)
        alive = np.flatnonzero(limit > 0)
        for k in range(self.every):
            alive = alive[self.words[a[alive] + k] == self.words[b[alive] + k]]
            if not len(alive):
                break
            found[alive] = k + 1
            alive = alive[limit[alive] > k + 1]
        return found

    def ask(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal from a on and from b on; a and b differ, in one part."""
        step = (self.member[(b - a) % self.every] - a) % self.every
        found = self._compare(a, b, step)
        go = np.flatnonzero(found == step)
        x, y = self._ranks(a[go] + step[go]), self._ranks(b[go] + step[go])
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        more = np.empty(len(go), np.int64)
        for k in np.unique(level).tolist():
            mine = level == k
            table = self.least[k]
            more[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << k) + 1])
        found[go] += more
        return found

    def _ranks(self, at: np.ndarray) -> np.ndarray:
        return self.rank[at // self.every * self.size + self.place[at % self.every]].astype(np.int64)


def grids(sizes: np.ndarray, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Points (text, period, place in the text) of the grids of all periods, short periods
    first, about GRID at once; periods up to two on their own, as most long runs have them."""
    periods = sizes // exponent
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    by = np.argsort(period, kind="stable")
    text, period = text[by], period[by]
    points = -(-(sizes[text] - period) // ((exponent - 1) * period))
    cuts = np.flatnonzero((np.diff(np.cumsum(points) // GRID) > 0) | ((period[1:] == 3) & (period[:-1] < 3))) + 1
    for rows in np.split(np.arange(len(text)), cuts):
        n = points[rows]
        which = np.repeat(rows, n)
        turn = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        yield text[which], period[which], turn * (exponent - 1) * period[which]


def distinct(rows: np.ndarray) -> np.ndarray:
    """Rows once each, in order."""
    rows = rows[np.lexsort(rows.T[::-1])]
    return rows[np.append(True, (rows[1:] != rows[:-1]).any(1))] if len(rows) else rows


def runs_of(words: np.ndarray, sizes: np.ndarray, exponent: int = 4, least: int = 6) -> np.ndarray:
    """(text, start, length, period) of all runs, by text, start and period: maximal
    stretches of a smallest period q with at least max(least, exponent*q) words. `words` are the numbers of the words of texts in turn, `sizes` how many each has.
    """
    none = np.zeros((0, 4), np.int64)
    if not len(words):
        return none
    # a terminator before each text and after the last, and room to look two words ahead
    top, n = int(words.max()) + 1, len(sizes)
    begin = np.cumsum(sizes + 1) - sizes
    line = np.zeros(len(words) + n + 3, np.int64)
    line[begin - 1] = top + np.arange(n)
    line[len(words) + n:] = top + n + np.arange(3)
    inside = np.ones(len(words) + n, bool)
    inside[begin - 1] = False
    line[:len(words) + n][inside] = words
    # a run has this many pairs of equal words in a row at least, so on one side of any of them
    reach = min(2, (min(max(least, exponent * q) - q for q in range(1, least + 1)) - 1) // 2)
    # where the longest runs known so far lie: what repeats inside one by a multiple of its
    # period is the same run
    known, step = np.zeros(len(line), np.int64), np.ones(1, np.int64)
    forward = backward = None
    found = [none]
    for text, period, at in grids(sizes, exponent):
        at = at + begin[text]
        new = line[at] == line[at + period]
        text, period, at = text[new], period[new], at[new]
        ahead, behind = np.ones(len(at), bool), np.ones(len(at), bool)
        for k in range(1, reach + 1):
            ahead &= line[at + k] == line[np.minimum(at + period + k, len(line) - 1)]
            behind &= line[np.maximum(at - k, 0)] == line[np.maximum(at + period - k, 0)]
        same = known[at]
        new = (ahead | behind) & ~((same > 0) & (same == known[at + period]) & (period % step[same] == 0))
        text, period, at = text[new], period[new], at[new]
        if not len(at):
            continue
        if forward is None:
            part = np.zeros(len(line), np.int64)
            part[begin] = 1
            part = np.cumsum(part)
            forward = Extensions(line, part)
            # read backwards a text ends at the terminator before it
            part = np.zeros(len(line), np.int64)
            part[begin - 1] = 1
            part = np.cumsum(part)
            backward = Extensions(line[::-1], part[-1] - part[::-1])
        right = forward.ask(at, at + period)
        left = backward.ask(len(line) - 1 - at, len(line) - 1 - at - period) - 1
        start, length = at - left, left + right + period
        good = length >= np.maximum(least, exponent * period)
        rows = distinct(np.stack([text, start, period, length], 1)[good])
        found.append(rows)
        big = rows[rows[:, 3] >= 64]
        big = big[np.lexsort((-big[:, 2], big[:, 3]))]
        for k, (_, s, _, size) in enumerate(big.tolist(), len(step)):
            known[s:s + size] = k
        step = np.append(step, big[:, 2])
    rows = distinct(np.concatenate(found))
    if not len(rows):
        return none
    # one stretch, several periods: the smallest divides the others
    by = np.lexsort((rows[:, 2], rows[:, 3], rows[:, 1]))
    rows = rows[by]
    once = np.append(True, (rows[1:, 1] != rows[:-1, 1]) | (rows[1:, 3] != rows[:-1, 3]))
    rows = rows[once]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1]))]
    return np.stack([rows[:, 0], rows[:, 1] - begin[rows[:, 0]], rows[:, 3], rows[:, 2]], 1)


def collapsed(sizes: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which words of the texts in turn are kept: of each run its first period."""
    begin = np.cumsum(sizes) - sizes
    change = np.zeros(int(sizes.sum()) + 1, np.int64)
    start = begin[runs[:, 0]] + runs[:, 1]
    np.add.at(change, start + runs[:, 3], 1)
    np.add.at(change, start + runs[:, 2], -1)
    return np.cumsum(change[:-1]) == 0


def texts_of_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in turn, and how many each text has."""
    data, begins, _ = joined(texts)
    starts, ends = word_spans(data)
    sizes = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    body = np.ascontiguousarray(data[~IS_SPACE[data]])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]), sizes


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", words_col: str = "n_words",
              collapsed_col: str = "collapsed", exponent: int = 4, least: int = 6, chunk_bytes: int = 2 << 20) -> DataFrame:
    """`docs` with the number of words of its text, its runs (start, length and period in
    words, by start, then period) and the text without repeats: words joined by one space,
    of each run only the first period. `exponent` is how often a period must stand at
    least (2 or more), `least` the words of the shortest run.

    Nulls: a null text is empty; other columns are passed through. Texts without words
    have no run and collapse to the empty text. Very long texts: a row is worked on whole,
    in memory of about 200 bytes a word. Repeated rows and ties: each row on its own.
    Empty table: no rows. Columns of `docs` called like the new ones are replaced.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period twice at least")
    ship(docs)
    docs = without(docs, runs_col, words_col, collapsed_col)
    schema = with_fields(docs, f"`{words_col}` bigint, `{runs_col}` array<struct<start: bigint, length: bigint, "
                               f"period: bigint>>, `{collapsed_col}` string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, chunk_bytes):
            words, sizes = texts_of_words(text_bytes(batch.column(text_col)))
            numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            runs = runs_of(numbers, sizes, exponent, least)
            kept = collapsed(sizes, runs)
            ends = np.cumsum(kept)[np.cumsum(sizes) - 1] if len(kept) else np.zeros(len(sizes), np.int64)
            ends = np.where(np.cumsum(sizes) > 0, ends, 0)
            left = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), words.filter(pa.array(kept)))
            plain = pc.binary_join(left, b" ")
            at = np.searchsorted(runs[:, 0], np.arange(len(sizes) + 1))
            found = pa.ListArray.from_arrays(
                pa.array(at, pa.int32()), pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(RUN)))
            yield pa.record_batch([*batch.columns, pa.array(sizes, pa.int64()), found, plain.view(pa.string())],
                                  names=[*batch.schema.names, words_col, runs_col, collapsed_col])

    return docs.mapInArrow(run, schema)
