"""Ranked search: the documents that score highest for each query, by sparse ball trees.

A document is a sparse vector over the terms of the queries, and its score for a query an
inner product in whole numbers. Documents are gathered, some thousand at a time, into a
tree of balls: a node knows the centroid of its documents and the radius around it. No
document x of a node can reach more than q.c + |q'|r, where q' is the query on the terms
that occur in the node; rounding is made up for, so the bound holds as computed. Each query
goes through the nodes best bound first and ends where a bound falls below the worst of the
best documents found so far, in this tree and all before it in the task. Documents of the
leaves it reaches are scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import cut_lineage, joined, ship, slices, text_bytes

# Bytes that are part of a term: letters, digits, and all of any character beyond ASCII
TERM = np.zeros(256, bool)
TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32

SLACK = 1e-9  # more than the relative rounding of any sum made here
NO_ID = 1 << 63  # where documents without an id stand among equal scores
FOUND = "query int, item_id bigint, doc_id bigint, score bigint"


def terms_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in turn, A-Z lower-cased, and how many each text has."""
    data, begins, _ = joined(texts)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = TERM[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    sizes = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    body = np.ascontiguousarray(SMALL[data[TERM[data]]])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]), sizes


@dataclass
class Queries:
    """Queries and their terms: `places` in the vocabulary and how often each stands there."""

    ids: list[int]
    vocabulary: pa.Array
    places: list[np.ndarray]
    times: list[np.ndarray]

    @classmethod
    def of(cls, ids: list[int], texts: list[bytes]) -> Queries:
        terms, sizes = terms_of(texts)
        coded = terms.dictionary_encode()
        counted = [np.unique(part, return_counts=True) for part in np.split(
            coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(sizes)[:-1])] if texts else []
        return cls(ids, coded.dictionary, [c[0] for c in counted], [c[1].astype(np.int64) for c in counted])


def term_places(terms: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    """Place of each term in the vocabulary, -1 for terms no query has."""
    return pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def counted(sizes: np.ndarray, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, times) of the terms that queries have, by text and place."""
    text = np.repeat(np.arange(len(sizes)), sizes)[places >= 0]
    key, times = np.unique(text * width + places[places >= 0], return_counts=True)
    return key // width, key % width, times


@dataclass(frozen=True)
class Corpus:
    """What a score needs to know of all documents; `weights` by place in the vocabulary."""

    documents: int
    terms: int
    weights: np.ndarray

    @classmethod
    def of(cls, documents: int, terms: int, holding: np.ndarray) -> Corpus:
        return cls(documents, terms, np.array([
            math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], np.int64))

    def parts(self, sizes: np.ndarray, text: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How much of a term's weight a document gives, of a million; `sizes` are its terms."""
        long = np.array([75 + 25 * n * self.documents // max(1, self.terms) for n in sizes.tolist()], np.int64)
        return 1_000_000_000 * times // (1000 * times + 12 * long[text])


class BallTree:
    """Documents as rows of a sparse matrix (`begin` of each row, `column`, `value`, whole
    numbers above zero; no row is empty), brought into the order of the leaves."""

    def __init__(self, begin: np.ndarray, column: np.ndarray, value: np.ndarray, scale: np.ndarray, leaf: int = 16):
        self.scale = scale
        self.width, real = len(scale), value * scale[column]
        length = np.diff(np.append(begin, len(column)))
        square = np.add.reduceat(real * real, begin)
        order = np.arange(len(begin))
        self.first, self.last, self.left, self.right, self.radius, centroids = [], [], [], [], [], []

        def cells(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.cumsum(length[rows]) - length[rows]
            return np.repeat(begin[rows] - at, length[rows]) + np.arange(length[rows].sum()), at

        work = [(0, len(order), -1)]
        while work:
            a, b, parent = work.pop()
            rows = order[a:b]
            flat, at = cells(rows)
            cols, vals = column[flat], real[flat]
            centre = np.bincount(cols, weights=vals, minlength=self.width) / (b - a)
            middle = float(centre @ centre)
            away = square[rows] - 2 * np.add.reduceat(vals * centre[cols], at) + middle
            far = int(np.argmax(away))
            node = len(self.first)
            if parent >= 0:
                (self.left if self.left[parent] < 0 else self.right)[parent] = node
            self.first.append(a)
            self.last.append(b)
            self.left.append(-1)
            self.right.append(-1)
            noise = SLACK * (float(square[rows].max()) + middle)
            self.radius.append(math.sqrt(max(0.0, float(away[far])) + noise))
            centroids.append(centre)
            if b - a <= leaf or away[far] <= noise:
                continue
            # the document farthest from the centre, the one farthest from that, and all
            # others by where they lie between the two
            to_far = self._dots(vals, cols, at, *cells(rows[far:far + 1])[:1], real, column)
            other = int(np.argmax(square[rows] - 2 * to_far))
            to_other = self._dots(vals, cols, at, *cells(rows[other:other + 1])[:1], real, column)
            order[a:b] = rows[np.argsort(to_other - to_far, kind="stable")]
            half = (a + b) // 2
            work += [(half, b, node), (a, half, node)]
        self.order = order
        flat, self.begin = cells(order)
        self.begin = np.append(self.begin, len(flat))
        self.column, self.value = column[flat], value[flat]
        self.centroid = np.array(centroids)
        self.radius = np.array(self.radius)

    def _dots(self, vals, cols, at, flat, real, column) -> np.ndarray:
        one = np.zeros(self.width)
        one[column[flat]] = real[flat]
        return np.add.reduceat(vals * one[cols], at)

    def bounds(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No document of a node scores more than this for the query."""
        # documents are scaled up by what the query is scaled down by
        query = weights / self.scale[places]
        centre = self.centroid[:, places]
        reach = np.sqrt((centre > 0) @ (query * query))
        return (centre @ query + reach * self.radius) * (1 + SLACK) + 1

    def search(self, places: np.ndarray, weights: np.ndarray, ids: np.ndarray, best: list, k: int) -> int:
        """Brings the best of these documents into `best`, a heap of (score, -id) of at most
        k; `ids` belong to the rows as given. Returns how many documents were scored."""
        bounds = self.bounds(places, weights)
        dense = np.zeros(self.width, np.int64)
        dense[places] = weights
        todo, scored = [(-bounds[0], 0)], 0
        while todo:
            bound, node = heappop(todo)
            if len(best) == k and -bound < best[0][0]:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if len(best) < k or bounds[child] >= best[0][0]:
                        heappush(todo, (-bounds[child], child))
                continue
            a, b = self.first[node], self.last[node]
            x, y = self.begin[a], self.begin[b]
            scores = np.add.reduceat(self.value[x:y] * dense[self.column[x:y]], self.begin[a:b] - x)
            scored += b - a
            least = best[0][0] if len(best) == k else 1
            for r in np.flatnonzero(scores >= max(1, least)).tolist():
                entry = (int(scores[r]), -int(ids[self.order[a + r]]))
                if len(best) < k:
                    heappush(best, entry)
                elif entry > best[0]:
                    heapreplace(best, entry)
        return scored


def corpus_counts(batches: Iterable[pa.RecordBatch], vocabulary: pa.Array, text_col: str, chunk_bytes: int
                  ) -> Iterator[pa.RecordBatch]:
    """(term, count) of a task: documents that hold a term; -1 all with any term, -2 all terms."""
    holding, documents, terms = np.zeros(len(vocabulary), np.int64), 0, 0
    for batch in slices(batches, text_col, chunk_bytes):
        found, sizes = terms_of(text_bytes(batch.column(text_col)))
        documents += int(np.count_nonzero(sizes))
        terms += len(found)
        if len(vocabulary):
            _, places, _ = counted(sizes, term_places(found, vocabulary), len(vocabulary))
            holding += np.bincount(places, minlength=len(vocabulary))
    some = np.flatnonzero(holding)
    yield pa.record_batch([pa.array(np.append(some, [-1, -2]), pa.int32()),
                           pa.array(np.append(holding[some], [documents, terms]), pa.int64())], names=["term", "n"])


def matrices(batches: Iterable[pa.RecordBatch], queries: Queries, corpus: Corpus, id_col: str, text_col: str,
             chunk_bytes: int, most_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, begin, places, value, known places) of documents that share a term with a query,
    about `most_rows` at a time."""
    width, wait = len(queries.vocabulary), []

    def put() -> tuple:
        ids, lengths, places, values = (np.concatenate(x) for x in zip(*wait))
        wait.clear()
        known, column = np.unique(places, return_inverse=True)
        return ids, np.cumsum(lengths) - lengths, column, values, known

    for batch in slices(batches, text_col, chunk_bytes):
        terms, sizes = terms_of(text_bytes(batch.column(text_col)))
        text, places, times = counted(sizes, term_places(terms, queries.vocabulary), width)
        values = corpus.parts(sizes, text, times)
        some = (values > 0) & (corpus.weights[places] > 0)
        text, places, values = text[some], places[some], values[some]
        rows, lengths = np.unique(text, return_counts=True)
        ids = np.array([NO_ID if x is None else x for x in batch.column(id_col).to_pylist()], object)[rows]
        ends = np.cumsum(lengths)
        for a in range(0, len(rows), most_rows):
            b = min(a + most_rows, len(rows))
            x, y = int(ends[a] - lengths[a]), int(ends[b - 1])
            wait.append((ids[a:b], lengths[a:b], places[x:y], values[x:y]))
            if sum(len(w[0]) for w in wait) >= most_rows or sum(len(w[2]) for w in wait) > 1 << 20:
                yield put()
    if wait:
        yield put()


def find_best(batches: Iterable[pa.RecordBatch], queries: Queries, corpus: Corpus, id_col: str, text_col: str, k: int,
              leaf: int, chunk_bytes: int, most_rows: int) -> Iterator[pa.RecordBatch]:
    """(query, item_id, doc_id, score): the k best documents of a task for each query."""
    best: list[list] = [[] for _ in queries.ids]
    weights = [t * corpus.weights[p] for p, t in zip(queries.places, queries.times)]
    local = np.full(len(queries.vocabulary), -1, np.int64)
    for ids, begin, column, value, known in matrices(batches, queries, corpus, id_col, text_col, chunk_bytes, most_rows):
        # rare terms count more in a score, so let them count more in a distance
        tree = BallTree(begin, column, value, np.sqrt(corpus.weights[known].astype(float)), leaf)
        local[known] = np.arange(len(known))
        for q, heap in enumerate(best):
            places = local[queries.places[q]]
            here = places >= 0
            if here.any():
                tree.search(places[here], weights[q][here], ids, heap, k)
        local[known] = -1
    rows = [(q, queries.ids[q], None if -i == NO_ID else -i, s) for q, heap in enumerate(best) for s, i in sorted(heap, reverse=True)]
    if rows:
        columns = list(zip(*rows))
        yield pa.record_batch([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                              names=["query", "item_id", "doc_id", "score"])


def rank_documents(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   query_id_col: str = "item_id", query_text_col: str = "text", k: int = 20, leaf: int = 16,
                   block_bytes: int = 4 << 20, chunk_bytes: int = 2 << 20, most_rows: int = 1024) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents that score highest for each query, if
    they score at all, the best first and equal scores by id.

    The queries are a stated set: they are counted first and sent in blocks of about
    `block_bytes` of text, two passes over the documents for each block (counts, then the
    search). Documents are never shuffled; a task returns at most k rows a query, and these
    are ranked in 64 parts before the last ranking.

    Nulls: null texts have no terms, and count neither as documents nor as results; a
    document without an id stands last among equal scores. Queries without a term have no
    row, those without an id keep a null. Ties: by id. Repeated rows: each row is a document
    or a query of its own. Very long texts: a row is worked on whole. Empty tables: no rows.
    Extra columns are not read.
    """
    ship(docs)
    spark = docs.sparkSession
    asked = queries.select(F.col(f"`{query_id_col}`").cast("bigint").alias("item"),
                           F.coalesce(F.col(f"`{query_text_col}`"), F.lit("")).alias("text"))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    docs = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = None
    for part in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == part).collect()
        block = Queries.of([r[0] for r in rows], [r[1].encode() for r in rows])
        sent = spark.sparkContext.broadcast(block)
        counts = docs.select("text").mapInArrow(
            lambda b, sent=sent: corpus_counts(b, sent.value.vocabulary, "text", chunk_bytes), "term int, n bigint")
        numbers = {r[0]: r[1] for r in counts.groupBy("term").agg(F.sum("n")).collect()}
        holding = np.zeros(len(block.vocabulary), np.int64)
        for term, n in numbers.items():
            if term >= 0:
                holding[term] = n
        corpus = spark.sparkContext.broadcast(Corpus.of(numbers.get(-1, 0), numbers.get(-2, 0), holding))
        best = docs.mapInArrow(lambda b, sent=sent, corpus=corpus: find_best(
            b, sent.value, corpus.value, "id", "text", k, leaf, chunk_bytes, most_rows), FOUND)
        best = best.withColumn("query", F.col("query") + F.lit(part) * F.lit(1 << 24))
        if blocks > 1:  # one block at a time on the driver and the executors
            best = cut_lineage(best)
            sent.destroy()
            corpus.destroy()
        found = best if found is None else found.union(best)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = Window.partitionBy("query", F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("part")).orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= k)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
