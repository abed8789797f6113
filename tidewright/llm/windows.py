"""Repeated windows of a fixed length over a whole corpus: what the suffix-array and
the FM-index operators share.

A window is `length` units (bytes or words) in a row within one document. Comparing
all windows with all others would move every text `length` times. Instead:

1. Each window is named by the smallest hash among the `gram`-unit pieces in it, so
   equal windows have equal names. Neighbouring windows share their name: a run of
   them is a *segment*, about one per (length - gram) / 2 units. Per chunk of
   documents, equal segments are collapsed, then names are dealt to buckets.
2. In a bucket, equal segments are collapsed again. Only names that stand for two or
   more different segments (or a segment that repeats itself) need a closer look.
3. Their content is fetched from the texts and dealt to buckets by name.
4. There `search` (a suffix array, an FM-index) finds which windows repeat.
5. The removed intervals meet their documents.

Skew: copies of a text or passage collapse in the chunk and in the bucket, so a hot
group adds at most one row per chunk. A name with more than `hot` different segments
(a passage in ever new surroundings) is split into single windows, dealt by the hash
of the whole window, which spreads it over all buckets. Nothing is dropped.

Documents are told apart by (id, 32-bit hash of the text). Rows equal in both are
repeated rows; a null id counts as one id above all others; a null text is empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import (PIECES, U, by_bucket, cut_lineage, dealt, gathered, mixed, packed, pieces, ship, slices, text_bytes,
                     text_key, unpacked, words_of)

NAME = np.dtype([("m", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("h", "<u4"), ("start", "<u4"), ("n", "<u2"), ("flags", "u1")])
SPAN = np.dtype([("doc", "<i8"), ("h", "<u4"), ("start", "<u4"), ("stop", "<u4")])
SELF, MANY, HOT = 1, 2, 4
SPANS, NAMES, ASKED, CONTENT, ROWS = 0, 1, 2, 3, 4
NO_ID = np.iinfo(np.int64).max

# From contents of segments in a bucket to a mask over their windows: which to remove
Search = Callable[[list[np.ndarray], np.ndarray, "Windows"], list[np.ndarray]]


@dataclass(frozen=True)
class Windows:
    unit: str                     # "byte" or "word"
    length: int                   # units in a window
    gram: int                     # units in a piece that may name a window
    first_stays: bool             # keep the first of equal windows, or remove all
    longest: int = 512            # windows in a segment
    hot: int = 20_000             # different segments of one name in one bucket
    chunk_bytes: int = 2 << 20    # text worked on at once
    bucket_bytes: int = 8 << 20   # text that one bucket stands for

    def units(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.unit == "word":
            return words_of(texts)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        return np.frombuffer(b"".join(texts), np.uint8), sizes

    @property
    def dtype(self) -> np.dtype:
        return np.dtype("<u8") if self.unit == "word" else np.dtype("u1")


def gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each `gram` units in a row. Bytes are taken eight at a time."""
    n = len(values) - gram + 1
    if values.dtype == np.uint8 and gram >= 8:
        values = np.ndarray((len(values) - 7,), "<u8", np.ascontiguousarray(values), strides=(1,))
        offsets = sorted({*range(0, gram - 7, 8), gram - 8})
    else:
        offsets = range(gram)
    found = np.zeros(n, U)
    for k, at in enumerate(offsets):
        found += values[at:at + n].astype(U, copy=False)
        found *= U(0x9E3779B97F4A7C15 + 2 * k)
        found ^= found >> U(29)
    return mixed(found)


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best value among each `width` in a row."""
    reach = 1
    while 2 * reach <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    return values if reach == width else best(values[:len(values) - (width - reach)], values[width - reach:])


def segments(values: np.ndarray, counts: np.ndarray, w: Windows) -> tuple[np.ndarray, ...]:
    """Start, number of windows, name, and whether it may hold equal windows, of each segment."""
    if len(values) < w.length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, bool)
    width = w.length - w.gram + 1
    hashes = gram_hashes(values, w.gram)
    names = sliding(hashes, width, np.minimum)
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[:len(names)]
    whole = np.arange(w.length, w.length + len(names)) <= ends[doc]
    cut = np.ones(len(names), bool)
    cut[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])
    at = np.flatnonzero(cut)
    size = np.diff(np.append(at, len(names)))
    at, size = at[whole[at]], size[whole[at]]
    parts = -(-size // w.longest)
    of = np.repeat(np.arange(len(at)), parts)
    skip = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * w.longest
    at, size = at[of] + skip, np.minimum(w.longest, size[of] - skip)
    # a segment holds equal windows only if the piece that names it stands in it twice
    edge = np.zeros(width - 1, U)
    marks = np.flatnonzero(sliding(np.concatenate([edge, names, edge]), width, np.maximum) == hashes)
    twice = np.flatnonzero(hashes[marks[1:]] == hashes[marks[:-1]])
    one, two = marks[twice], marks[twice + 1]
    k = np.searchsorted(one, at)
    again = np.append(two, len(values) * 2)[k] <= at + size + width - 2
    return at, size, names[at], again


def bucket_of(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    return (mixed(doc.astype(U) * U(3) + h.astype(U)) % U(n)).astype(np.int64)


def collapsed(rows: np.ndarray, first_stays: bool, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal segments made one. Returns segments that are removed whole, and the first
    of each set of equal ones; those whose name stands for others too have n > 0 and
    are the ones to look at (flags: MANY if its copies are removed, HOT if split)."""
    rows = rows[np.lexsort((rows["start"], rows["h"], rows["doc"], rows["c"], rows["m"]))]
    if not len(rows):
        return rows, rows
    same = np.ones(len(rows), bool)
    for f in ("m", "c", "doc", "h", "start"):
        same[1:] &= rows[f][1:] == rows[f][:-1]
    same[0] = False
    if same.any():  # the same place twice: repeated rows
        keep = np.flatnonzero(~same)
        flags = np.bitwise_or.reduceat(rows["flags"], keep)
        rows = rows[keep]
        rows["flags"] = flags
    new_m = np.ones(len(rows), bool)
    new_m[1:] = rows["m"][1:] != rows["m"][:-1]
    new = new_m.copy()
    new[1:] |= rows["c"][1:] != rows["c"][:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(rows)))
    flags = np.bitwise_or.reduceat(rows["flags"], first)
    if first_stays:
        gone = rows[~new]
    else:
        many = (count > 1) | (flags & MANY > 0)
        flags = flags | np.where(many, MANY, 0).astype("u1")
        gone = rows[np.repeat(many, count)]
    rows = rows[first]
    rows["flags"] = flags
    group = np.cumsum(new_m[first]) - 1
    kinds = np.bincount(group)
    rows["flags"] |= np.where(kinds[group] > hot, HOT, 0).astype("u1")
    if first_stays:
        look = (kinds[group] > 1) | (rows["flags"] & SELF > 0)
    else:  # something not removed yet must be there
        open_ = rows["flags"] & MANY == 0
        look = np.bincount(group, open_)[group].astype(bool) & ((kinds[group] > 1) | (rows["flags"] & SELF > 0))
    rows["n"][~look] = 0
    return gone, rows


def spans(doc: np.ndarray, h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Intervals, joined where they touch."""
    order = np.lexsort((stop, start, h, doc))
    doc, h, start, stop = doc[order], h[order], start[order].astype(np.int64), stop[order].astype(np.int64)
    if not len(doc):
        return np.zeros(0, SPAN)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    of = np.cumsum(new) - 1
    high = np.maximum.accumulate(stop + of * (1 << 33)) - of * (1 << 33)
    new[1:] |= start[1:] > high[:-1]
    first = np.flatnonzero(new)
    found = np.zeros(len(first), SPAN)
    found["doc"], found["h"], found["start"] = doc[first], h[first], start[first]
    found["stop"] = high[np.append(first[1:], len(doc)) - 1]
    return found


def spans_of(rows: np.ndarray, w: Windows) -> np.ndarray:
    return spans(rows["doc"], rows["h"], rows["start"], rows["start"].astype(np.int64) + rows["n"] + (w.length - 1))


def _ids(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def name_rows(batches: Iterable[pa.RecordBatch], id_col: str, text_col: str, w: Windows, buckets: int):
    """Step 1. A document's place in the chunk follows (id, hash), so place order is
    document order there."""
    digest = xxhash.xxh3_64_intdigest
    for batch in slices(batches, text_col, w.chunk_bytes):
        ids, texts = _ids(batch, id_col), text_bytes(batch.column(text_col))
        own = {(i, text_key(t)): t for i, t in zip(ids.tolist(), texts)}
        keys = sorted(own)
        values, counts = w.units([own[k] for k in keys])
        at, size, name, again = segments(values, counts, w)
        if not len(at):
            continue
        data, width = values.tobytes(), values.dtype.itemsize
        rows = np.zeros(len(at), NAME)
        rows["c"] = np.fromiter((digest(data[a:b]) for a, b in zip((at * width).tolist(),
                                 ((at + size + w.length - 1) * width).tolist())), U, len(at))
        begins = np.cumsum(counts) - counts
        doc = np.searchsorted(np.cumsum(counts), at, side="right")
        rows["m"], rows["n"], rows["start"], rows["flags"] = name, size, at - begins[doc], again * SELF
        rows["doc"] = np.array([k[0] for k in keys], np.int64)[doc]
        rows["h"] = np.array([k[1] for k in keys], np.uint32)[doc]
        size_of = rows["n"].copy()
        # collapse by content within the chunk; names are judged in their bucket
        order = np.lexsort((rows["c"], rows["m"]))
        rows, size_of = rows[order], size_of[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["m"][1:] != rows["m"][:-1]) | (rows["c"][1:] != rows["c"][:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(rows)))
        gone = rows[~new] if w.first_stays else rows[np.repeat(count > 1, count)]
        rows = rows[first]
        if not w.first_stays:
            rows["flags"] |= np.where(count > 1, MANY, 0).astype("u1")
        cut = spans_of(gone, w)
        yield from dealt(SPANS, bucket_of(cut["doc"], cut["h"], buckets), cut)
        yield from dealt(NAMES, (rows["m"] % U(buckets)).astype(np.int64), rows)


def judge_names(batches: Iterable[pa.RecordBatch], w: Windows, buckets: int):
    """Step 2: intervals to remove, and segments to look at, dealt by document."""
    for bucket, rows in gathered(batches):
        names = []
        for kind, blob in rows:
            if kind == SPANS:
                yield pieces([(bucket, SPANS, blob)])
            else:
                names.append(blob)
        gone, kept = collapsed(np.frombuffer(b"".join(names), NAME), w.first_stays, w.hot)
        cut = spans_of(gone, w)
        yield from dealt(SPANS, bucket_of(cut["doc"], cut["h"], buckets), cut)
        kept = kept[kept["n"] > 0]
        yield from dealt(ASKED, bucket_of(kept["doc"], kept["h"], buckets), kept)


def row_blobs(batches: Iterable[pa.RecordBatch], id_col: str, text_col: str, w: Windows, buckets: int):
    """Whole rows, packed and dealt by document."""
    for batch in slices(batches, text_col, w.chunk_bytes):
        texts = text_bytes(batch.column(text_col))
        h = np.fromiter(map(text_key, texts), np.int64, len(texts))
        to = bucket_of(_ids(batch, id_col), h, buckets)
        order = np.argsort(to, kind="stable")
        at = np.append(np.flatnonzero(np.diff(to[order], prepend=-1)), len(to))
        yield pieces((int(to[order[a]]), ROWS, packed(batch.take(pa.array(order[a:b])))) for a, b in zip(at[:-1], at[1:]))


def by_document(records: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    records = records[np.lexsort((records["start"], records["h"], records["doc"]))]
    if not len(records):
        return {}
    new = np.ones(len(records), bool)
    new[1:] = (records["doc"][1:] != records["doc"][:-1]) | (records["h"][1:] != records["h"][:-1])
    at = np.append(np.flatnonzero(new), len(records))
    return {(int(records["doc"][a]), int(records["h"][a])): records[a:b] for a, b in zip(at[:-1], at[1:])}


def fetch(batches: Iterable[pa.RecordBatch], id_col: str, text_col: str, w: Windows, buckets: int):
    """Step 3: contents of the segments asked for, dealt by name; hot ones window by window."""
    double = xxhash.xxh3_128_intdigest
    for _, rows in gathered(batches):
        asked, wanted = [], None
        for kind, blob in rows:
            if kind == ASKED:
                asked.append(blob)
                continue
            if wanted is None:
                wanted = by_document(np.frombuffer(b"".join(asked), NAME))
            batch = unpacked(blob)
            texts = text_bytes(batch.column(text_col))
            found = [(t, hit) for i, t in zip(_ids(batch, id_col).tolist(), texts)
                     if (hit := wanted.pop((i, text_key(t)), None)) is not None]
            if not found:
                continue
            values, counts = w.units([t for t, _ in found])
            begins = np.cumsum(counts) - counts
            segs, single = [], []
            for begin, (_, hit) in zip(begins.tolist(), found):
                for r in hit:
                    a, n = begin + int(r["start"]), int(r["n"])
                    if not r["flags"] & HOT:
                        segs.append((r, values[a:a + n + w.length - 1]))
                        continue
                    for k in range(n):
                        d = double(values[a + k:a + k + w.length].tobytes())
                        single.append((d >> 64, d & (1 << 64) - 1, r["doc"], r["h"], r["start"] + k, 1, r["flags"] & MANY))
            if segs:
                heads = np.array([s[0] for s in segs], NAME)
                to = (heads["m"] % U(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                at = np.append(np.flatnonzero(np.diff(to[order], prepend=-1)), len(order))
                yield pieces((int(to[order[a]]), CONTENT,
                              np.int64(b - a).tobytes() + heads[order[a:b]].tobytes()
                              + b"".join(segs[k][1].tobytes() for k in order[a:b])) for a, b in zip(at[:-1], at[1:]))
            names = np.array(single, NAME)
            yield from dealt(NAMES, (names["m"] % U(buckets)).astype(np.int64), names)


def judge_contents(batches: Iterable[pa.RecordBatch], w: Windows, search: Search, buckets: int):
    """Step 4: intervals to remove, dealt by document."""
    for _, rows in gathered(batches):
        names, heads, contents = [], [], []
        for kind, blob in rows:
            if kind == NAMES:
                names.append(blob)
                continue
            n = int(np.frombuffer(blob, "<i8", 1)[0])
            head = np.frombuffer(blob, NAME, n, 8)
            heads.append(head)
            sizes = head["n"].astype(np.int64) + (w.length - 1)
            values = np.frombuffer(blob, w.dtype, offset=8 + n * NAME.itemsize)
            contents += np.split(values, np.cumsum(sizes)[:-1])
        cut = []
        if names:
            cut.append(spans_of(collapsed(np.frombuffer(b"".join(names), NAME), w.first_stays, w.hot)[0], w))
        if heads:
            head = np.concatenate(heads)
            order = np.lexsort((head["start"], head["h"], head["doc"]))
            head = head[order]
            masks = search([contents[k] for k in order], head, w)
            hit = np.flatnonzero(np.concatenate(masks))
            of = np.repeat(np.arange(len(head)), head["n"])[hit]
            begins = np.cumsum(head["n"], dtype=np.int64) - head["n"]
            start = head["start"][of].astype(np.int64) + hit - begins[of]
            cut.append(spans(head["doc"][of], head["h"][of], start, start + w.length))
        for c in cut:
            yield from dealt(SPANS, bucket_of(c["doc"], c["h"], buckets), c)


def with_spans(batches: Iterable[pa.RecordBatch], id_col: str, text_col: str, w: Windows,
               finish: Callable[[pa.RecordBatch, list[bytes], list[np.ndarray]], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 5. Of repeated rows, one is the first; the others are removed whole (all of
    them, unless the first stays) if they hold a window."""
    for _, rows in gathered(batches):
        cut, known, seen = [], None, {}
        waiting = []
        for kind, blob in rows:
            if kind == SPANS:
                cut.append(blob)
                continue
            if known is None:
                known = by_document(np.frombuffer(b"".join(cut), SPAN))
            batch = unpacked(blob)
            for key in zip(_ids(batch, id_col).tolist(), map(text_key, text_bytes(batch.column(text_col)))):
                seen[key] = seen.get(key, 0) + 1
            waiting.append(blob)
        done = set()
        for blob in waiting:
            batch = unpacked(blob)
            texts = text_bytes(batch.column(text_col))
            found = []
            for i, t in zip(_ids(batch, id_col).tolist(), texts):
                key = (i, text_key(t))
                if seen[key] > 1 and (key in done or not w.first_stays):
                    size = int(w.units([t])[1][0])
                    found.append(np.array([[0, size]]) if size >= w.length else np.zeros((0, 2), np.int64))
                else:
                    hit = known.get(key)
                    if hit is None:
                        found.append(np.zeros((0, 2), np.int64))
                    else:
                        hit = spans(hit["doc"], hit["h"], hit["start"], hit["stop"])
                        found.append(np.stack([hit["start"], hit["stop"]], 1).astype(np.int64))
                done.add(key)
            yield finish(batch, texts, found)


def removed_windows(docs: DataFrame, id_col: str, text_col: str, w: Windows, search: Search,
                    finish: Callable, schema: str) -> DataFrame:
    """Steps 1 to 5. `finish` turns a batch of `docs`, its texts and their removed
    intervals into rows of `schema`."""
    ship(docs)
    total = docs.select(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    buckets = 1 + total // w.bucket_bytes
    keys = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    names = keys.mapInArrow(lambda b: name_rows(b, id_col, text_col, w, buckets), PIECES)
    judged = cut_lineage(by_bucket(names).mapInArrow(lambda b: judge_names(b, w, buckets), PIECES))
    texts = keys.mapInArrow(lambda b: row_blobs(b, id_col, text_col, w, buckets), PIECES)
    contents = by_bucket(judged.filter(F.col("kind") == ASKED).union(texts)).mapInArrow(
        lambda b: fetch(b, id_col, text_col, w, buckets), PIECES)
    late = by_bucket(contents).mapInArrow(lambda b: judge_contents(b, w, search, buckets), PIECES)
    whole = docs.mapInArrow(lambda b: row_blobs(b, id_col, text_col, w, buckets), PIECES)
    return by_bucket(judged.filter(F.col("kind") == SPANS).union(late).union(whole)).mapInArrow(
        lambda b: with_spans(b, id_col, text_col, w, finish), schema)
