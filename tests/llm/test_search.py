"""Ranked search beside scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np

from llm_cases import SF, awkward, nothing  # noqa: F401
from tidewright.llm.balltree import BallTree, rank_documents
from tidewright.llm.queries import QUERIES


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
            for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_ranks(docs, items, k=20):
    """All documents scored for all items; docs and items are lists of (id, text)."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    rows = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        rows += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def some(seed, n_docs=400, n_items=25):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice('abcÉß日')}{k}" for k in range(300)]
    pick = lambda n: " ".join(rng.choice(vocabulary[:rng.choice([20, 300])]).upper() if rng.random() < .1
                              else rng.choice(vocabulary) for _ in range(n))
    docs = [(d, pick(rng.choice([1, 5, 60, 300]))) for d in range(n_docs)]
    docs += [(n_docs + d, docs[rng.randrange(20)][1]) for d in range(150)]  # copies: equal scores
    return docs, [(i, pick(rng.choice([1, 3, 40]))) for i in range(n_items)]


def test_ranks_beside_scoring_all(spark):
    docs, items = some(1)
    items += [(3, items[3][1] + " again again"), (100, None), (101, "!!! ..."), (102, "nowhere"), (103, "")]
    rows = docs + [(None, docs[0][1]), (None, "É0"), (9001, None), (9002, ""), (9003, "-- !!")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = plain_ranks(rows, items)
    assert found(rank_documents(d, i)) == want
    assert found(rank_documents(d, i, most_rows=37, leaf=2, chunk_bytes=5_000)) == want
    assert found(rank_documents(d, i, block_bytes=500)) == want  # several blocks of queries
    assert found(rank_documents(d, i, k=3)) == plain_ranks(rows, items, 3)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    width, rows = 200, []
    for topic in range(12):
        middle = rng.choice(width, 12, replace=False)
        for _ in range(60):
            cols = np.unique(np.append(middle, rng.choice(width, rng.integers(1, 3))))
            rows.append((cols, rng.integers(100_000, 1_000_000, len(cols))))
    lengths = np.array([len(r[0]) for r in rows])
    column, value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    weights = rng.integers(1, 9000, width)
    tree = BallTree(np.cumsum(lengths) - lengths, column, value, np.sqrt(weights.astype(float)), 8)
    assert sorted(tree.order.tolist()) == list(range(len(rows)))
    total = 0
    for _ in range(40):
        places = np.sort(rng.choice(width, 12, replace=False)) if rng.random() < 0.5 else rows[rng.integers(len(rows))][0]
        dense = np.zeros(width, np.int64)
        dense[places] = weights[places] * rng.integers(1, 4, len(places))
        scores = np.array([int((dense[c] * v).sum()) for c, v in rows])
        bounds = tree.bounds(places, dense[places])
        for node, bound in enumerate(bounds):
            assert bound >= scores[tree.order[tree.first[node]:tree.last[node]]].max()
        best: list = []
        total += tree.search(places, dense[places], np.arange(len(rows)), best, 5)
        assert sorted(best, reverse=True) == sorted(((int(s), -d) for d, s in enumerate(scores) if s), reverse=True)[:5]
    assert total < 0.8 * 40 * len(rows)  # subtrees were left out


def test_query_beside_scoring_all(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert found(QUERIES["op13_ranked_search"](spark, SF)) == plain_ranks(docs, items)


def test_awkward_rows(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "WORD a null"), (2, "日本語の文"), (None, "byte")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(rank_documents(awkward, items)) == plain_ranks(rows, [tuple(r) for r in items.collect()])
    assert rank_documents(nothing, items).count() == 0
    assert rank_documents(awkward, nothing, query_id_col="doc_id").count() == 0
