"""SimHash near-dedup: fingerprints of word shingles, linked at a small Hamming distance.

Fingerprints that differ in at most `radius` of 64 bits agree in all but `radius` of
radius + 6 parts, so every choice of six parts is a key and linked fingerprints share
at least one. Only the parts outside the key can differ: a key holds at most
2^(64 - key bits) different fingerprints (65,536 at radius 2), however many documents
there are, and copies count once. Within a key, fingerprints are compared bit-sliced:
plane b holds bit b of 64 fingerprints in one word; differences of one fingerprint to
all 64 are counted in two carry-save bits, and a word is given up once all 64 counts
exceed the radius.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import (PIECES, U, by_bucket, cut_lineage, dealt, fresh, gathered, mixed, pieces, ship, slices, text_bytes, with_fields,
                     without)
from .graph import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ALL = U(0xFFFFFFFFFFFFFFFF)
PAIR = np.dtype([("a", "<u8"), ("b", "<u8")])


def shingle_hashes(texts: list[bytes], words: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of each text, in turn; none for a text without words."""
    digest = xxhash.xxh64_intdigest
    for text in texts:
        found = re.findall(rb"[^\x20\x09-\x0D]+", text.translate(LOWER))
        if not found:
            yield np.zeros(0, U)
            continue
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(sizes + 1) - 1
        begins = ends - sizes
        line = b" ".join(found)
        last = max(1, len(found) - words + 1)
        yield np.fromiter((digest(line[a:b], seed) for a, b in zip(
            begins[:last].tolist(), ends[min(words, len(found)) - 1:].tolist())), U, last)


def shingle_bits(texts: list[bytes], words: int, seed: int) -> Iterator[int]:
    """The fingerprint of each text."""
    return map(majority, shingle_hashes(texts, words, seed))


def majority(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """Bits that are set in over half of the hashes; none without hashes."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), block):
        part = hashes[k:k + block]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 3, seed: int = 42, out: str = "fingerprint_bits",
                 chunk_bytes: int = 4 << 20) -> DataFrame:
    """`docs` without the text column, with the 64-bit fingerprint of its text (a long)."""
    ship(docs)
    rest = [c for c in without(docs, text_col, out).columns]
    schema = with_fields(without(docs, text_col, out), f"`{out}` bigint")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, chunk_bytes):
            bits = np.fromiter(shingle_bits(text_bytes(batch.column(text_col)), words, seed), U, batch.num_rows)
            yield pa.record_batch([*(batch.column(c) for c in rest), pa.array(bits.view(np.int64))], names=[*rest, out])

    return docs.mapInArrow(run, schema)


def parts_of(n: int) -> list[int]:
    """Masks of n parts of the 64 bits, about equal."""
    edges = [64 * k // n for k in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def key_masks(radius: int, agree: int = 6) -> np.ndarray:
    """A mask for every choice of `agree` of radius + agree parts."""
    parts = parts_of(radius + agree)
    return np.array([sum(c) for c in combinations(parts, agree)], U)


def planes_of(values: np.ndarray) -> np.ndarray:
    """(words, 64): bit j of [w, b] is bit b of fingerprint 64 w + j."""
    full = np.zeros(-(-len(values) // 64) * 64, U)
    full[:len(values)] = values
    bits = np.unpackbits(full.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")  # word, lane, bit
    return np.ascontiguousarray(np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")).view("<u8")[:, :, 0]


def within(query: np.ndarray, word: np.ndarray, planes: np.ndarray, radius: int, free: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of a fingerprint and a word of 64 others: which pairs are left, and
    their lanes within the radius. Only the `free` bits can differ.

    Counts are kept vertically: digit[k] holds bit k of the 64 counts. A count that
    would pass the radius is marked in `over` for good.
    """
    digits = radius.bit_length()
    at = np.arange(len(query))
    digit = [np.zeros(len(at), U) for _ in range(digits)]
    over = np.zeros(len(at), U)
    for step, b in enumerate(free):
        differs = planes[word[at], b] ^ (U(0) - (query[at] >> U(b) & U(1)))
        carry = differs
        for k in range(digits):
            digit[k], carry = digit[k] ^ carry, digit[k] & carry
        over |= carry
        reached = ALL  # counts of radius + 1
        for k in range(digits):
            reached = reached & (digit[k] if (radius + 1) >> k & 1 else ~digit[k])
        if (radius + 1) >> digits == 0:
            over |= reached
        if step % 4 == 3 or step == len(free) - 1:
            live = over != ALL
            if not live.all():
                at, over, digit = at[live], over[live], [d[live] for d in digit]
                if not len(at):
                    break
    return at, ~over


def links_of(values: np.ndarray, key: np.ndarray, mask: int, radius: int, block: int = 1 << 17,
             places: bool = False, silent: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Pairs (a < b) within the radius among fingerprints, sorted by key, of equal keys: the
    fingerprints, or their places. `silent` ones meet only those before them in their key."""
    free = [b for b in range(64) if not mask >> b & 1]
    new = np.flatnonzero(np.diff(key, prepend=key[:1] ^ U(1)) != 0)
    sizes = np.diff(np.append(new, len(key)))
    new, sizes = new[sizes > 1], sizes[sizes > 1]
    if not len(new):
        return
    # each key's fingerprints stand in words of their own
    n_words = -(-sizes // 64)
    first_word = np.cumsum(n_words) - n_words
    of = np.repeat(np.arange(len(new)), sizes)
    place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lane = first_word[of] * 64 + place
    padded = np.zeros(int(n_words.sum()) * 64, U)
    source = new[of] + place
    member = values[source]
    padded[lane] = member
    lane_source = np.zeros(len(padded), np.int64)
    lane_source[lane] = source
    used = np.zeros(len(padded), np.uint8)
    used[lane] = 1
    used = np.packbits(used, bitorder="little").view("<u8")
    planes = planes_of(padded)
    # a fingerprint meets its own word and the later ones of its key
    own = lane >> 6
    to_go = first_word[of] + n_words[of] - own
    if silent is not None:
        to_go[silent[source]] = 0
    ends = np.cumsum(to_go)
    a = 0
    while a < len(member):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + block)))
        count = to_go[a:b]
        q = np.repeat(np.arange(a, b), count)
        word = own[q] + np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)
        at, near = within(member[q], word, planes, radius, free)
        if len(at):
            q, word = q[at], word[at]
            near &= used[word]
            mine = word == own[q]  # in the own word, only later lanes
            shift = (lane[q] & 63).astype(U)
            near[mine] &= (ALL << shift[mine]) << U(1)
            hit = np.flatnonzero(near)
            bits = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, j = np.nonzero(bits)
            pairs = np.zeros(len(row), PAIR)
            x, y = source[q[hit[row]]], lane_source[word[hit[row]] * 64 + j]
            if not places:
                x, y = values[x], values[y]
            pairs["a"], pairs["b"] = np.minimum(x, y), np.maximum(x, y)
            yield pairs
        a = b


def fingerprint_links(distinct: DataFrame, radius: int = 2, column: str = "bits", bucket_rows: int = 50_000) -> DataFrame:
    """(a, b): all pairs of different fingerprints that differ in at most `radius` bits."""
    ship(distinct)
    masks = key_masks(radius)
    buckets = 1 + distinct.count() * len(masks) // bucket_rows

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy(zero_copy_only=False).view(U)
            for k, mask in enumerate(masks):
                yield from dealt(k, (mixed((bits & mask) ^ U(k << 56)) % U(buckets)).astype(np.int64), bits)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in gathered(batches):
            by_mask: dict[int, list[bytes]] = {}
            for kind, blob in rows:
                by_mask.setdefault(kind, []).append(blob)
            for k, blobs in by_mask.items():
                bits = np.frombuffer(b"".join(blobs), U)
                key = bits & masks[k]
                order = np.argsort(key, kind="stable")
                for pairs in links_of(bits[order], key[order], int(masks[k]), radius):
                    differ = pairs["a"] ^ pairs["b"]
                    earlier = np.zeros(len(pairs), bool)  # told by a choice of parts before this one
                    for mask in masks[:k]:
                        earlier |= differ & mask == 0
                    pairs = pairs[~earlier]
                    yield pa.record_batch([pa.array(pairs[c].copy().view(np.int64)) for c in "ab"], names=["a", "b"])

    keyed = distinct.select(column).mapInArrow(deal, PIECES)
    return by_bucket(keyed).mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2,
                    seed: int = 42, bits_col: str = "fingerprint_bits", component_col: str = "component_id") -> DataFrame:
    """`docs` without its text, with the fingerprint and `component_id`, the smallest id
    that can be reached over links of at most `radius` differing bits.

    The fingerprint: A-Z in lower case, words, shingles of `words` words (repeats
    included; a shorter text is one shingle), the XXH64 of each; a bit is set if it is
    in over half of them. No word: zero, which links like any other.

    Nulls: a null text has no word; a null id never names a component unless all its
    ids are null. Repeated rows are copies like any others. Empty table: no rows.
    Columns of `docs` called like the new ones are replaced.
    """
    known = cut_lineage(fingerprints(without(docs, bits_col, component_col), text_col, words, seed, bits_col))
    found = label_fingerprints(known, id_col, bits_col, radius)
    key = fresh(known, "bits")
    return known.join(found.withColumnRenamed("bits", key).withColumnRenamed("component", component_col),
                      F.col(f"`{bits_col}`") == F.col(key), "left").drop(key)


def label_fingerprints(known: DataFrame, id_col: str, bits_col: str, radius: int) -> DataFrame:
    """(bits, component) for each fingerprint of `known`: the smallest id of its component."""
    distinct = cut_lineage(known.groupBy(F.col(f"`{bits_col}`").alias("bits")).agg(F.min(f"`{id_col}`").alias("low")))
    links = cut_lineage(fingerprint_links(distinct, radius))
    roots = components(links)
    named = distinct.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn(
        "root", F.coalesce("root", "bits"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    return cut_lineage(named.join(lowest, "root").select("bits", "component"))


def hex_bits(bits):
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


# Near copies by similarity: the same fingerprints at a wide radius. No choice of parts
# is short enough there, so fingerprints meet where small hashes of their shingles agree;
# what they find is then checked on the shingles themselves.

BINS = 128
MEMBER = np.dtype([("key", "<u8"), ("node", "<i8"), ("bits", "<u8"), ("label", "<i8"), ("sketch", "u1", BINS)])
LINK = np.dtype([("a", "<i8"), ("b", "<i8")])


def band_keys(hashes: np.ndarray, bands: int, rows: int, block: int = 1 << 14) -> np.ndarray:
    """One key per band: the smallest of the shingle hashes under `rows` orders. Two texts
    of similarity s share a band's key with chance s ** rows."""
    n = bands * rows
    factors = mixed(np.arange(1, n + 1, dtype=U)) | U(1)
    low = np.full(n, np.iinfo(np.uint64).max, U)
    for k in range(0, len(hashes), block):
        low = np.minimum(low, (hashes[k:k + block, None] * factors ^ (factors >> U(7))).min(0))
    found = np.arange(bands, dtype=U)
    for r in range(rows):
        found = mixed(found * U(0x9E3779B97F4A7C15) + low[r::rows])
    return found


def sketch_of(grams: np.ndarray) -> np.ndarray:
    """BINS bytes of a set of hashes in rising order: each bin's smallest hash, as a byte;
    255 for an empty bin."""
    found = np.full(BINS, 255, np.uint8)
    bins, first = np.unique(grams & U(BINS - 1), return_index=True)
    found[bins.astype(np.int64)] = mixed(grams[first]) % U(255)
    return found


def likeness(a: np.ndarray, b: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """Estimated similarity of rows of sketches; two empty sets are alike."""
    found = np.ones(len(a))
    for k in range(0, len(a), block):
        x, y = a[k:k + block], b[k:k + block]
        either = ((x != 255) | (y != 255)).sum(1)
        both = ((x == y) & (x != 255)).sum(1)
        found[k:k + block] = np.where(either > 0, both / np.maximum(either, 1), 1.0)
    return found


def spanning(bits: np.ndarray, sketches: np.ndarray, radius: int, alike: float, most: int = 1 << 16,
             at_once: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links (places) that join all members within the radius and of likeness `alike` into
    trees, and the root of each tree. A member that is reached is compared no more, so a
    dense group costs little more than its size. Beyond `most` members the roots so far
    meet the next `most`."""
    links, roots = [np.zeros((0, 2), np.int64)], np.zeros(0, np.int64)
    free = list(range(64))
    for start in range(0, len(bits), most):
        here = np.concatenate([roots, np.arange(start, min(start + most, len(bits)))])
        planes = planes_of(bits[here])
        used = np.zeros(len(planes) * 64, np.uint8)
        used[:len(here)] = 1
        left = np.packbits(used, bitorder="little").view("<u8")
        roots_here = []

        def reach(lanes: np.ndarray) -> None:
            np.bitwise_and.at(left, lanes >> 6, ~(U(1) << (lanes & 63).astype(U)))

        while True:
            words = np.flatnonzero(left)
            if not len(words):
                break
            lane = int(words[0]) * 64 + (int(left[words[0]]) & -int(left[words[0]])).bit_length() - 1
            roots_here.append(lane)
            queue = np.array([lane])
            reach(queue)
            while len(queue):
                part, queue = queue[:at_once], queue[at_once:]
                words = np.flatnonzero(left)
                if not len(words):
                    break
                q, word = np.repeat(part, len(words)), np.tile(words, len(part))
                at, near = within(bits[here[q]], word, planes, radius, free)
                near &= left[word[at]]
                hit = np.flatnonzero(near)
                row, j = np.nonzero(np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                x, y = q[at[hit[row]]], word[at[hit[row]]] * 64 + j
                close = likeness(sketches[here[x]], sketches[here[y]]) >= alike
                y, first = np.unique(y[close], return_index=True)
                links.append(np.stack([here[x[close][first]], here[y]], 1))
                reach(y)
                queue = np.concatenate([queue, y])
        roots = here[np.array(roots_here, np.int64)]
    return np.concatenate(links), roots


def _groups(members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members in order of their key, without repeats; where each key begins, and its size."""
    members = members[np.lexsort((members["node"], members["key"]))]
    if not len(members):
        return members, np.zeros(0, np.int64), np.zeros(0, np.int64)
    new_key = np.concatenate([[True], members["key"][1:] != members["key"][:-1]])
    members = members[new_key | np.concatenate([[True], members["node"][1:] != members["node"][:-1]])]
    new = np.flatnonzero(np.concatenate([[True], members["key"][1:] != members["key"][:-1]]))
    return members, new, np.diff(np.append(new, len(members)))


def _ordered(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    links = np.zeros(len(x), LINK)
    links["a"], links["b"] = np.minimum(x, y), np.maximum(x, y)
    return links


def _thinned(members: np.ndarray, radius: int, crowd: int, alike: float) -> tuple[np.ndarray, np.ndarray]:
    """Members by key, those of crowded keys reduced to the roots of their trees of almost
    equal texts; and the trees' links."""
    members, new, sizes = _groups(members)
    stay, links = np.ones(len(members), bool), [np.zeros(0, LINK)]
    for a, n in zip(new[sizes > crowd].tolist(), sizes[sizes > crowd].tolist()):
        group = members[a:a + n]
        pairs, roots = spanning(group["bits"], group["sketch"], radius, alike)
        links.append(_ordered(group["node"][pairs[:, 0]], group["node"][pairs[:, 1]]))
        stay[a:a + n] = False
        stay[a + roots] = True
    return members[stay], np.concatenate(links)


def _members(batch: pa.RecordBatch) -> np.ndarray:
    """A member for each key of each row (node, bits, keys, sketch, label)."""
    keys = batch.column(2)
    of = np.repeat(np.arange(batch.num_rows), np.diff(keys.offsets.to_numpy()))
    members = np.zeros(len(of), MEMBER)
    members["key"] = keys.flatten().to_numpy().view(U)
    members["node"] = batch.column(0).to_numpy()[of]
    members["bits"] = batch.column(1).to_numpy().view(U)[of]
    members["sketch"] = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, BINS)[of]
    members["label"] = batch.column(4).to_numpy()[of]
    return members


def _told(links: np.ndarray) -> pa.RecordBatch:
    links = np.unique(links)
    return pa.record_batch([pa.array(links[c].copy()) for c in "ab"], names=["a", "b"])


def crowd_links(nodes: DataFrame, radius: int, similarity: float, crowd: int = 64, bucket_rows: int = 20_000) -> DataFrame:
    """(a, b): trees of nodes within the radius whose sketches are alike by a little more
    than the similarity, in keys with over `crowd` of them; to be checked. They only save comparisons: `similar_links` tells what they miss.
    Found first in each batch, before the shuffle, then among the roots in the whole key."""
    ship(nodes)
    total = nodes.select(F.sum(F.size("keys"))).first()[0] or 0
    buckets = 1 + total // bucket_rows
    alike = (1 + 3 * similarity) / 4

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                members, links = _thinned(_members(batch), radius, crowd, alike)
                yield from dealt(1, (mixed(links["a"].astype(U)) % U(buckets)).astype(np.int64), links)
                yield from dealt(0, (members["key"] % U(buckets)).astype(np.int64), members)

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in gathered(batches):
            held = []
            for kind, blob in rows:
                if kind == 1:
                    yield _told(np.frombuffer(blob, LINK))
                else:
                    held.append(blob)
            yield _told(_thinned(np.frombuffer(b"".join(held), MEMBER), radius, crowd, alike)[1])

    keyed = nodes.select("node", "bits", "keys", "sketch", F.col("node").alias("label")).mapInArrow(deal, PIECES)
    return by_bucket(keyed).mapInArrow(join, "a bigint, b bigint").distinct()


PAIRS, ASKED, SETS = 1, 2, 0


def similar_links(nodes: DataFrame, radius: int, similarity: float, block: int = 20_000, bucket_rows: int = 20_000) -> DataFrame:
    """(a, b): the pairs of `similar_pairs` as rows, each once."""
    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                yield _told(np.frombuffer(blob, LINK))

    packed = similar_pairs(nodes, radius, similarity, block, bucket_rows).filter(F.col("kind") == PAIRS)
    return packed.mapInArrow(unpack, "a bigint, b bigint").distinct()


def similar_pairs(nodes: DataFrame, radius: int, similarity: float, block: int = 20_000, bucket_rows: int = 20_000) -> DataFrame:
    """Per bucket, packed (PAIRS) and with the nodes they are of (ASKED): all pairs of nodes of different labels that share a key, differ in at most
    `radius` bits of the fingerprint and whose sketches do not speak against the similarity;
    to be checked. `nodes` has node, bits, keys (an array), sketch and label: nodes of one
    label are linked already.

    A key of one label has no such pair. Another key with over `block` nodes is cut into
    parts by the node, and each two parts meet in a bucket of their own."""
    ship(nodes)
    keys = nodes.select(F.explode("keys").alias("key"), "label").groupBy("key").agg(
        F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    total = nodes.select(F.sum(F.size("keys"))).first()[0] or 0
    buckets = 1 + total // bucket_rows
    large = {r.key % (1 << 64): 0 if r.low == r.high else -(-r.n // block) for r in keys.filter(F.col("n") > block).collect()}
    large_keys = np.array(sorted(large), U)
    loose = similarity - 0.15

    def cut(members: np.ndarray) -> np.ndarray:
        hot = np.isin(members["key"], large_keys)
        found = [members[~hot]]
        for key in np.unique(members["key"][hot]):
            parts, group = large[int(key)], members[members["key"] == key]
            own = mixed(group["node"].astype(U)) % U(max(parts, 1))
            for i, j in combinations(range(parts), 2):
                copy = group[(own == i) | (own == j)]
                copy["key"] = mixed(np.array([int(key)], U) ^ mixed(np.array([i * parts + j + 1], U)))[0]
                found.append(copy)
        return np.concatenate(found)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                members = cut(_members(batch)) if large else _members(batch)
                yield from dealt(0, (members["key"] % U(buckets)).astype(np.int64), members)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in gathered(batches):
            members, new, sizes = _groups(np.frombuffer(b"".join(blob for _, blob in rows), MEMBER))
            # the largest label of each key comes last and does not ask itself
            of = np.repeat(np.arange(len(new)), sizes)
            order = np.lexsort((members["label"], of))
            changed = np.diff(members["label"][order], prepend=0) != 0
            changed[new] = True
            run = np.cumsum(changed) - 1
            length = np.bincount(run, minlength=1)[run] if len(run) else run
            order = order[np.lexsort((run, length, of))]
            members = members[order]
            last = np.repeat(members["label"][new + sizes - 1], sizes)
            silent = members["label"] == last
            asked = np.zeros(len(members), bool)
            for pairs in links_of(members["bits"], members["key"], 0, radius, places=True, silent=silent):
                x, y = pairs["a"].astype(np.int64), pairs["b"].astype(np.int64)
                apart = members["label"][x] != members["label"][y]
                x, y = x[apart], y[apart]
                close = likeness(members["sketch"][x], members["sketch"][y]) >= loose
                x, y = x[close], y[close]
                asked[x] = asked[y] = True
                if len(x):
                    yield pieces([(bucket, PAIRS, np.unique(_ordered(members["node"][x], members["node"][y])).tobytes())])
            if asked.any():
                yield pieces([(bucket, ASKED, np.unique(members["node"][asked]).tobytes())])

    keyed = nodes.select("node", "bits", "keys", "sketch", "label").mapInArrow(deal, PIECES)
    return by_bucket(keyed).mapInArrow(compare, PIECES)


def links_that_hold(packed: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """(a, b): the pairs of `similar_pairs` whose sets of hashes have at least the similarity;
    `sets_of` gives (node, grams) for a table of nodes. A set goes once to each bucket that asks for it, and pairs
    never become rows before they hold, so a crowd costs its members in rows."""
    def nodes_asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
                nodes = pa.array(np.frombuffer(blob, "<i8"))
                yield pa.record_batch([pa.array(np.full(len(nodes), bucket, np.int32)), nodes], names=["bucket", "node"])

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in gathered(batches):
            known, grams = [], []
            held: HeldSets | None = None
            for kind, blob in rows:
                if kind == SETS:
                    known.append(int(np.frombuffer(blob, "<i8", 1)[0]))
                    grams.append(np.frombuffer(blob, "<u4", offset=8))
                    continue
                held = held or HeldSets(np.array(known, np.int64), grams)
                yield _told(held.alike(np.frombuffer(blob, LINK), similarity))

    def with_node(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "grams", 4 << 20):
            yield pieces((bucket, SETS, node.to_bytes(8, "little", signed=True) + grams) for bucket, node, grams in
                         zip(*(batch.column(c).to_pylist() for c in ("bucket", "node", "grams"))))

    asked = packed.filter(F.col("kind") == ASKED).select("bucket", "blob").mapInArrow(nodes_asked, "bucket int, node bigint")
    asked = cut_lineage(asked)
    given = asked.join(sets_of(asked.select("node")), "node").mapInArrow(with_node, PIECES)
    pairs = packed.filter(F.col("kind") == PAIRS)
    return by_bucket(given.union(pairs)).mapInArrow(verify, "a bigint, b bigint").distinct()


class HeldSets:
    """Sets of hashes of some nodes, to compare many pairs of them."""

    def __init__(self, nodes: np.ndarray, sets: list[np.ndarray]):
        order = np.argsort(nodes)
        self.nodes = nodes[order]
        self.sizes = np.array([len(sets[k]) for k in order], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        known, self.numbers = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
        self.mark = np.zeros(len(known), np.int32)

    def alike(self, links: np.ndarray, similarity: float, most: int = 1 << 20) -> np.ndarray:
        """The links whose sets have at least the similarity; the set of one end is marked,
        and the sets of all its others are counted against the marks."""
        links = links[np.argsort(links["a"], kind="stable")]
        a, b = np.searchsorted(self.nodes, links["a"]), np.searchsorted(self.nodes, links["b"])
        both = np.zeros(len(links), np.int64)
        cuts = np.append(np.flatnonzero(np.diff(a, prepend=-1)), len(a))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = self.numbers[self.begins[a[lo]]:self.begins[a[lo]] + self.sizes[a[lo]]]
            self.mark[own] = 1
            while lo < hi:
                stop = min(hi, lo + max(1, most // max(1, int(self.sizes[b[lo:hi]].max()))))
                n = self.sizes[b[lo:stop]]
                at = np.cumsum(n) - n
                flat = np.repeat(self.begins[b[lo:stop]] - at, n) + np.arange(n.sum())
                total = np.append(0, np.cumsum(self.mark[self.numbers[flat]]))
                both[lo:stop] = total[at + n] - total[at]
                lo = stop
            self.mark[own] = 0
        return links[both >= similarity * (self.sizes[a] + self.sizes[b] - both) - 1e-9]


def checked_links(pairs: DataFrame, sets: DataFrame, similarity: float, chunk_bytes: int = 4 << 20) -> DataFrame:
    """The pairs (a, b) whose sets of hashes (`sets`: node, grams) have at least the similarity."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "grams_a", chunk_bytes):
            keep = []
            for x, y in zip(batch.column("grams_a").to_pylist(), batch.column("grams_b").to_pylist()):
                x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    one = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    two = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "grams_a", "grams_b").mapInArrow(run, "a bigint, b bigint")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8,
                     radius: int = 21, bands: int = 16, rows: int = 4, seed: int = 42, chunk_bytes: int = 4 << 20) -> DataFrame:
    """`docs` without near copies: of each group, one row of the smallest id stays.

    Near copies share at least `similarity` of their shingles of `words` words (lower-case
    A-Z; Jaccard of the sets). Fingerprints are of the sets too: at 0.8 they differ in about
    ten of 64 bits and in more than `radius` once in thousands; texts meet by `bands` keys of `rows` small hashes,
    of which such a pair shares one with chance 0.9998. Every link is checked on the whole
    sets. In crowded keys checked trees come first, then only pairs that these do not
    connect are compared, so groups are those of all links, whatever the crowd or layout.

    Texts are read once for fingerprints and sets, then only the kept rows move. Nulls: a
    null text is like an empty one, and texts without words are alike; a null id is above
    all others. Repeated rows: one stays. Empty table: no rows. Extra columns are kept as
    they are.
    """
    ship(docs)
    id_key, text_key = fresh(docs, "__id"), fresh(docs, "__text")
    keyed = docs.withColumns({id_key: F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(2**63 - 1)),
                              text_key: F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", chunk_bytes):
            bits, keys, sketches, sets = [], [], [], []
            for hashes in shingle_hashes(text_bytes(batch.column("text")), words, seed):
                grams = np.unique(hashes)
                bits.append(majority(grams))
                keys.append(band_keys(grams, bands, rows))
                sketches.append(sketch_of(grams).tobytes())
                sets.append(np.unique((grams >> U(32)).astype("<u4")).tobytes())
            flat = np.concatenate(keys).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * bands, pa.int32()), pa.array(flat))
            yield pa.record_batch([batch.column("id"), batch.column("node"), pa.array(np.array(bits, U).view(np.int64)), lists,
                                   pa.array(sketches, pa.binary()), pa.array(sets, pa.binary())],
                                  names=["id", "node", "bits", "keys", "sketch", "grams"])

    known = keyed.select(F.col(id_key).alias("id"), F.col(text_key).alias("node"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known = cut_lineage(known.mapInArrow(run, "id bigint, node bigint, bits bigint, keys array<bigint>, sketch binary, grams binary"))
    firsts = known.groupBy("node").agg(F.min("id").alias("id"))
    nodes = cut_lineage(known.select("node", "id", "bits", "keys", "sketch").join(firsts, ["node", "id"]).dropDuplicates(["node"]))

    def checked(pairs: DataFrame) -> DataFrame:
        return cut_lineage(checked_links(pairs, sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node"))), similarity))

    def sets_of(asked: DataFrame) -> DataFrame:
        first = asked.distinct().join(nodes.select("node", "id"), "node")
        return cut_lineage(known.select("node", "id", "grams").join(first, ["node", "id"]).dropDuplicates(["node"]))

    trees = checked(cut_lineage(crowd_links(nodes, radius, similarity)))
    labels = components(trees).withColumnRenamed("node", "linked")
    labelled = cut_lineage(nodes.join(labels, F.col("node") == F.col("linked"), "left").select(
        "node", "bits", "keys", "sketch", F.coalesce("root", "node").alias("label")))
    packed = cut_lineage(similar_pairs(labelled, radius, similarity))
    links = trees.unionByName(links_that_hold(packed, sets_of, similarity))
    roots = components(cut_lineage(links)).withColumnRenamed("node", "linked")
    best = (nodes.select("node", "id").join(roots, F.col("node") == F.col("linked"), "left")
            .groupBy(F.coalesce("root", "node").alias("group")).agg(F.min(F.struct("id", "node")).alias("best"))
            .select(F.col("best.id").alias("best_id"), F.col("best.node").alias("best_node")))
    best = best.toDF(fresh(keyed, "best_id"), fresh(keyed, "best_node"))
    kept = keyed.join(best, (F.col(id_key) == F.col(best.columns[0])) & (F.col(text_key) == F.col(best.columns[1])), "left_semi")
    return kept.dropDuplicates([id_key, text_key]).select(*(F.col(f"`{c}`") for c in docs.columns))
