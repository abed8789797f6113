"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items are compared word by word (lower case, letters and digits
only). Running Karp-Rabin hashes of `min_match` words find the places where a document
shares a seed with an item; documents without one are done. For the others, the
longest matches that do not overlap are marked again and again, from the longest down
to `min_match` words. The share of an item's words that is tiled is its coverage: a
passage whose sentences change places is covered as well as one copied in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from .common import U, cut_lineage, joined, mixed, ship, slices, text_bytes, word_hashes

# Bytes that are part of a word: letters, digits, and all of any character beyond ASCII
PART = np.zeros(256, bool)
PART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
FOUND = "doc_id bigint, item_id bigint, coverage double, tiles array<struct<doc_word:int, item_word:int, words:int>>"


def plain_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in turn, and the number of words of each."""
    texts = [t if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts]
    data, begins, _ = joined(texts)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = PART[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    counts = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    return word_hashes(LOWER[data], starts, ends), counts


def running_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of each `size` words in a row."""
    n = max(0, len(words) - size + 1)
    found = np.zeros(n, U)
    for k in range(size if n else 0):
        found = found * U(0x9E3779B97F4A7C15) + words[k:k + n]
    return mixed(found)


@dataclass
class Items:
    """A block of benchmark items: their words, and their seeds in order."""

    ids: np.ndarray
    words: list[np.ndarray]
    seeds: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    table: np.ndarray  # whether any seed has these 20 leading bits

    @classmethod
    def of(cls, ids: list[int], texts: list[bytes], size: int) -> Items:
        words, counts = plain_words(texts)
        parts = np.split(words, np.cumsum(counts)[:-1]) if len(texts) else []
        hashes = [running_hashes(p, size) for p in parts]
        owners = np.repeat(np.arange(len(parts)), [len(h) for h in hashes])
        places = np.concatenate([np.arange(len(h)) for h in hashes]) if parts else np.zeros(0, int)
        seeds = np.concatenate(hashes) if parts else np.zeros(0, U)
        order = np.argsort(seeds, kind="stable")
        table = np.zeros(1 << 20, bool)
        table[seeds >> U(44)] = True
        return cls(np.array(ids, np.int64), parts, seeds[order], owners[order], places[order], table)

    def seed_hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in `hashes` that hold a seed, and its rank among the different seeds."""
        maybe = np.flatnonzero(self.table[hashes >> U(44)])
        at = np.searchsorted(self.seeds, hashes[maybe])
        good = self.seeds[np.minimum(at, len(self.seeds) - 1)] == hashes[maybe] if len(self.seeds) else np.zeros(0, bool)
        return maybe[good], at[good]


def tile(text: np.ndarray, item: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of words: (place in text, place in item,
    words) of matches that do not overlap, the longest first; of equal ones the first
    in the text, then in the item. None is shorter than `size`.

    Matches wait by length, longest first. One that has been cut into by longer ones goes
    back as what is left of it, so each is looked at once and once more per cut.
    """
    used_text, used_item = np.zeros(len(text) + 1, np.int32), np.zeros(len(item) + 1, np.int32)
    left_text, left_item, tiles = len(text), len(item), []
    waiting: dict[int, list[np.ndarray]] = {}
    found = _diagonals(text, item, size)
    found = found[np.argsort(found[:, 2], kind="stable")]
    for part in np.split(found, np.flatnonzero(np.diff(found[:, 2])) + 1) if len(found) else []:
        waiting[int(part[0, 2])] = [part[:, :2]]
    lengths = [-n for n in waiting]
    heapify(lengths)
    while lengths and min(left_text, left_item) >= size:
        n = -heappop(lengths)
        places = np.concatenate(waiting.pop(n))
        places = places[np.lexsort((places[:, 1], places[:, 0]))]
        before_text, before_item = np.cumsum(used_text) - used_text, np.cumsum(used_item) - used_item
        x, y = places[:, 0], places[:, 1]
        lost = np.maximum(before_text[x + n] - before_text[x], before_item[y + n] - before_item[y])
        for x, y in places[lost <= n - size].tolist():
            free = (used_text[x:x + n] | used_item[y:y + n]) == 0
            if free.all():
                used_text[x:x + n] = used_item[y:y + n] = 1
                left_text, left_item = left_text - n, left_item - n
                tiles.append((x, y, n))
                if min(left_text, left_item) < size:
                    break
                continue
            edge = np.flatnonzero(np.diff(free, prepend=False, append=False))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if b - a >= size:
                    if b - a not in waiting:
                        waiting[b - a] = []
                        heappush(lengths, a - b)
                    waiting[b - a].append(np.array([[x + a, y + a]]))
    return tiles


def _diagonals(text: np.ndarray, item: np.ndarray, size: int, most: int = 1 << 20) -> np.ndarray:
    """(place in text, place in item, words) of all matches that cannot be made longer.
    Seeds that follow one another on a diagonal make a match; the text is gone through in
    blocks of about `most` seeds, and matches that touch a block's end go on in the next."""
    ours, theirs = running_hashes(text, size), running_hashes(item, size)
    order = np.argsort(theirs, kind="stable")
    low = np.searchsorted(theirs[order], ours, side="left")
    count = np.searchsorted(theirs[order], ours, side="right") - low
    # equal hashes must be equal words: the item's among themselves, the text's with the first of them
    steps = np.arange(size)
    twins = np.flatnonzero(theirs[order][1:] == theirs[order][:-1])
    sound = bool((item[order[twins][:, None] + steps] == item[order[twins + 1][:, None] + steps]).all())
    if sound:
        some = np.flatnonzero(count)
        alike = (text[some[:, None] + steps] == item[order[low[some]][:, None] + steps]).all(1)
        count[some[~alike]] = 0
    ends = np.cumsum(count)
    done, open_ = [], np.zeros((0, 3), np.int64)
    a = 0
    while a < len(ours):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        n = count[a:b]
        x = np.repeat(np.arange(a, b), n)
        y = order[np.repeat(low[a:b], n) + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)]
        if not sound:
            same = (text[x[:, None] + steps] == item[y[:, None] + steps]).all(1)
            x, y = x[same], y[same]
        # what is open from before, as one seed of its own length, then the seeds by diagonal
        x0, y0 = np.append(open_[:, 0], x), np.append(open_[:, 1], y)
        length = np.append(open_[:, 2], np.full(len(x), size))
        by = np.lexsort((x0, x0 - y0))
        x0, y0, length = x0[by], y0[by], length[by]
        last = x0 + length - size  # the last seed of each
        new = np.ones(len(x0), bool)
        new[1:] = (x0[1:] - y0[1:] != x0[:-1] - y0[:-1]) | (x0[1:] != last[:-1] + 1)
        first = np.flatnonzero(new)
        stop = last[np.append(first[1:], len(x0)) - 1] if len(first) else last
        runs = np.stack([x0[first], y0[first], stop - x0[first] + size], 1)
        goes_on = stop == b - 1
        done.append(runs[~goes_on])
        open_ = runs[goes_on]
        a = b
    return np.concatenate([*done, open_])


def around(places: np.ndarray, size: int, reach: int, n: int) -> list[tuple[int, int]]:
    """Parts of a text that hold the places and `reach` words on both sides, joined where
    they meet: no tile can begin or end outside."""
    cuts = np.flatnonzero(np.diff(places) > 2 * reach + size) + 1
    return [(max(0, int(p[0]) - reach), min(n, int(p[-1]) + size + reach)) for p in np.split(places, cuts) if len(p)]


def matches(texts: list[bytes], items: Items, size: int, least: float) -> Iterator[tuple[int, int, float, list]]:
    """(row, item, coverage, tiles) of all texts that cover an item."""
    words, counts = plain_words(texts)
    if len(words) < size:
        return
    ends = np.cumsum(counts)
    at, rank = items.seed_hits(running_hashes(words, size))
    doc = np.searchsorted(ends, at, side="right")
    whole = at + size <= ends[doc]
    at, rank, doc = at[whole], rank[whole], doc[whole]
    for d in np.unique(doc).tolist():
        mine = doc == d
        begin, n = int(ends[d] - counts[d]), int(counts[d])
        for owner, places in _by_owner(items, at[mine] - begin, rank[mine]):
            item = items.words[owner]
            tiles = _tile_parts(words[begin:begin + n], item, np.unique(places), size)
            covered = sum(t[2] for t in tiles)
            if covered >= least * len(item):
                yield d, owner, covered / len(item), tiles


def find_items(batches: Iterable[pa.RecordBatch], sent: Broadcast, id_col: str, text_col: str, size: int, least: float,
               chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    items: Items = sent.value
    for batch in slices(batches, text_col, chunk_bytes):
        ids = batch.column(id_col).cast(pa.int64()).to_pylist()
        rows = [(ids[d], int(items.ids[owner]), share, tiles)
                for d, owner, share, tiles in matches(text_bytes(batch.column(text_col)), items, size, least)]
        if rows:
            yield pa.record_batch([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.float64()),
                pa.array([[dict(zip(("doc_word", "item_word", "words"), t)) for t in r[3]] for r in rows],
                         pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())])))],
                names=["doc_id", "item_id", "coverage", "tiles"])


def _tile_parts(text: np.ndarray, item: np.ndarray, places: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Tiles of the whole text: the parts around seeds, put together, with a word between
    them that stands nowhere else."""
    parts = around(places, size, len(item), len(text))
    if len(parts) == 1 and parts[0] == (0, len(text)):
        return tile(text, item, size)
    gap = np.array([_absent(item)], U)
    joined_text = np.concatenate([x for a, b in parts for x in (text[a:b], gap)])
    starts = np.cumsum([0, *(b - a + 1 for a, b in parts)])
    found = []
    for x, y, n in tile(joined_text, item, size):
        k = int(np.searchsorted(starts, x, side="right")) - 1
        found.append((parts[k][0] + x - int(starts[k]), y, n))
    return found


def _absent(item: np.ndarray) -> int:
    value = 1
    while (item == U(value)).any():
        value += 1
    return value


def _by_owner(items: Items, places: np.ndarray, rank: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of a document's seeds, for each item that has them."""
    high = np.searchsorted(items.seeds, items.seeds[rank], side="right")
    count = high - rank
    which = np.repeat(rank, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    owner, place = items.owners[which], np.repeat(places, count)
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for o, p in zip(np.split(owner, cuts), np.split(place, cuts)):
        if len(o):
            yield int(o[0]), p


def _blocks(docs: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, min_match: int,
            block_bytes: int) -> Iterator[tuple[Broadcast, bool]]:
    """The benchmark in blocks of at most about `block_bytes` of text, sent one at a time,
    and whether there are several."""
    items = benchmark.select(F.col(f"`{item_col}`").cast("bigint").alias("item"),
                             F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).filter("item is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + 2 * total // block_bytes if total > block_bytes else 1
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).distinct().collect()
        yield docs.sparkSession.sparkContext.broadcast(
            Items.of([r[0] for r in rows], [r[1].encode() for r in rows], min_match)), blocks > 1


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", min_match: int = 5, least: float = 0.6,
                 block_bytes: int = 16 << 20, chunk_bytes: int = 2 << 20) -> DataFrame:
    """(doc_id, item_id, coverage, tiles) for every document that tiles cover `least` of
    an item's words of. Documents without such an item have no row.

    The benchmark is a stated set of queries. It is counted first and sent in blocks of
    at most `block_bytes` of text, one pass over the documents for each; documents are
    never shuffled.

    Nulls: null texts are empty; items without an id are left out, documents without one
    keep a null. Items of fewer than `min_match` words cannot be told from chance and
    match nothing. Very long texts: a text and an item are compared in blocks of seeds, so
    memory goes by their words, not by their repeats. Ties: see `tile`. Repeated rows: a row
    each. Empty tables: no rows. Extra columns are not read.
    """
    ship(docs)
    docs = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    found = None
    for sent, several in _blocks(docs, benchmark, item_col, item_text_col, min_match, block_bytes):
        part = docs.mapInArrow(
            lambda b, sent=sent: find_items(b, sent, id_col, text_col, min_match, least, chunk_bytes), FOUND)
        if several:  # one block at a time on the driver and the executors
            part = cut_lineage(part)
            sent.destroy()
        found = part if found is None else found.union(part)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", min_match: int = 5, least: float = 0.6, block_bytes: int = 16 << 20,
                  chunk_bytes: int = 2 << 20) -> DataFrame:
    """`docs` without the rows whose text covers a benchmark item (see `contaminated`); same
    columns. Only texts go through Python, and a flag comes back; rows never move."""
    ship(docs)
    for sent, several in _blocks(docs, benchmark, item_col, item_text_col, min_match, block_bytes):
        docs = docs.filter(~_holds_item(sent, min_match, least, chunk_bytes)(F.col(f"`{text_col}`")))
        if several:
            docs = cut_lineage(docs)
            sent.destroy()
    return docs


def _holds_item(sent: Broadcast, size: int, least: float, chunk_bytes: int):
    @F.arrow_udf(returnType="boolean")
    def holds_item(texts: pa.Array) -> pa.Array:
        found = [np.zeros(0, bool)]
        for part in slices([pa.record_batch([texts], names=["text"])], "text", chunk_bytes):
            held = np.zeros(part.num_rows, bool)
            for row, *_ in matches(text_bytes(part.column("text")), sent.value, size, least):
                held[row] = True
            found.append(held)
        return pa.array(np.concatenate(found))

    return holds_item
