"""The pipeline's stages, each beside a plain version on its own input."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import compare
from llm_cases import SF, awkward, nothing  # noqa: F401
from tidewright.llm.queries import QUERIES, SQL
from tidewright.llm.simhash import LINK, HeldSets, keep_one_of_each, similar_links

WORD = r"[^\x20\x09-\x0D]+"


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_beside_sql(spark, name):
    assert compare(spark, SF, name).startswith("ok")


def shingles(text, n=5):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def family(rng, base, copies, swaps):
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(swaps):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def left_by_brute_force(rows, similarity=0.8):
    """Smallest id of each group that links of at least the similarity connect."""
    sets, root = {d: shingles(t) for d, t in rows}, {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d for d in ids if find(d) == d}


def test_one_of_each_group_of_near_copies(spark):
    """Copies with one word changed (similarity about 0.9), with three (about 0.74, so only
    some pairs count), and crowds of both kinds, beside all pairs tried."""
    rng = random.Random(4)
    new = lambda: [f"w{rng.randrange(3000)}" for _ in range(200)]
    texts = [" ".join(new()) for _ in range(60)]
    for swaps in (1, 3):
        for copies in [6] * 25 + [300]:
            texts += family(rng, new(), copies, swaps)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {r.doc_id for r in keep_one_of_each(docs).collect()}
    want = left_by_brute_force(rows)
    assert set(range(60)) <= kept
    assert want - kept == set()  # nothing below the similarity goes
    assert len(kept - want) <= 0.02 * (len(rows) - len(want))


def test_texts_that_share_long_passages_stay(spark):
    """Half of each text stands in all of them: similarity about a third, far below 0.8."""
    rng = random.Random(5)
    shared = " ".join(f"s{k}" for k in range(300))
    rows = [(k, shared + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert keep_one_of_each(docs).count() == 400


def test_recall_of_similar_pairs(spark):
    """Pairs of similarity 0.8 and more in the given documents fall into one group."""
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: shingles(r.text) for r in docs.collect()}
    kept = {r.doc_id for r in keep_one_of_each(docs).collect()}
    ids, pairs, both = sorted(rows), 0, 0
    by = {}
    for d in ids:
        for s in rows[d]:
            by.setdefault(s, []).append(d)
    close = Counter((a, b) for m in by.values() if len(m) < 60 for i, a in enumerate(m) for b in m[i + 1:])
    for (a, b), n in close.items():
        if n >= 0.8 * len(rows[a] | rows[b]):
            pairs += 1
            both += a in kept and b in kept
    assert pairs > 50 and both <= 0.01 * pairs


def test_awkward_rows_through_every_stage(spark, awkward, nothing):
    wide = awkward.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint"),
                                "spans": F.lit(1), "__kept": F.lit(2), "token_ids": F.lit(3)})
    for docs, least in ((wide, 1), (wide.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            if name == "quality_rules" and least:
                out = docs  # would leave none of these
                assert stage(spark, docs, SF).columns == docs.columns
            else:
                out = stage(spark, docs, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            assert out.count() >= least


def test_stages_on_the_given_documents(spark):
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    judged = {r.doc_id for r in QUERIES["op1_quality_rules"](spark, sf).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == judged
    cut = {r.doc_id: r for r in corpus_pipeline.substring_dedup(spark, docs, sf).collect()}
    for r in docs.collect():
        assert cut[r.doc_id].n_chars == (len(cut[r.doc_id].text) if cut[r.doc_id].text != r.text else r.n_chars)
    # all copies went, so no window is left that stood twice
    whole = {r.doc_id: re.findall(WORD, r.text) for r in docs.collect()}
    seen = Counter(tuple(w[i:i + 35]) for w in whole.values() for i in range(len(w) - 34))
    for d, w in whole.items():
        gone = {i + k for i in range(len(w) - 34) if seen[tuple(w[i:i + 35])] > 1 for k in range(35)}
        assert re.findall(WORD, cut[d].text) == [x for k, x in enumerate(w) if k not in gone]
    clean = corpus_pipeline.benchmark_decontamination(spark, docs, sf)
    leaked = {r.doc_id for r in QUERIES["op5_benchmark_decontamination"](spark, sf).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    bad = {texts[d] for d in leaked}
    assert {r.doc_id for r in clean.collect()} == {d for d, t in texts.items() if t not in bad}
    result = corpus_pipeline.run(spark, sf)
    assert result.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids", "decoded_sha256"]
    assert 0 < result.count() < docs.count()


def swapped(rng, words, at):
    words = list(words)
    for k in at:
        words[k] = f"new{rng.randrange(10**9)}"
    return words


def test_links_that_only_a_member_of_a_crowd_has(spark):
    """A crowd of almost equal texts; some others are like one of its members only, some
    are a little less than alike to all. Beside all pairs tried, in two layouts."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    crowd = [swapped(rng, base, [40 * (k % 10) + 10, 40 * (k // 10 % 10) + 25]) for k in range(150)]
    far = [swapped(rng, m, [40 * j + 2 for j in range(7)]) for m in rng.sample(crowd, 25)]
    under = [swapped(rng, base, [44 * j + 8 for j in range(9)]) for _ in range(40)]
    rows = list(enumerate(" ".join(t) for t in crowd + far + under))
    want = left_by_brute_force(rows)
    assert 10 < len(want) < 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for layout in (docs.coalesce(1), docs.repartition(7)):
        assert {r.doc_id for r in keep_one_of_each(layout).collect()} == want


def test_parts_of_a_large_key_meet(spark):
    """A key cut into parts tells the same pairs as a whole one, none within a label."""
    rng = random.Random(9)
    rows = [(k, rng.getrandbits(3), [7, 100 + k % 3], bytes(128), k if k < 40 else -1) for k in range(100)]
    nodes = spark.createDataFrame(rows, "node long, bits long, keys array<long>, sketch binary, label long")
    want = {(a, b) for a in range(100) for b in range(a + 1, 100) if a < 40}
    for block in (1000, 30):
        assert {(r.a, r.b) for r in similar_links(nodes, 21, 0.8, block=block).collect()} == want


def test_a_repeated_line_hides_no_copy(spark):
    """Similarity is of sets: a line that stands 20 times counts once."""
    rng, rows = random.Random(10), []
    for k in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(500)]
        line = [f"l{rng.randrange(10**6)}" for _ in range(10)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words + line * 20))]
    assert left_by_brute_force(rows) == set(range(0, 60, 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in keep_one_of_each(docs).collect()} == set(range(0, 60, 2))


def test_sets_are_compared_as_one_by_one():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, rng.integers(0, 30)).astype("<u4")) for _ in range(60)]
    nodes = rng.permutation(1000)[:60].astype(np.int64) - 500
    links = np.zeros(800, LINK)
    links["a"], links["b"] = nodes[rng.integers(0, 60, 800)], nodes[rng.integers(0, 60, 800)]
    own = dict(zip(nodes.tolist(), sets))
    want = []
    for a, b in links.tolist():
        both = len(np.intersect1d(own[a], own[b]))
        if both >= 0.3 * (len(own[a]) + len(own[b]) - both) - 1e-9:
            want.append((a, b))
    held = HeldSets(nodes, sets)
    assert sorted(held.alike(links, 0.3).tolist()) == sorted(want) and len(want) > 100
    assert sorted(held.alike(links, 0.3, most=1).tolist()) == sorted(want)
