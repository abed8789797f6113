"""SimHash fingerprints, links and components beside brute force."""

import random
import re

import numpy as np
import xxhash

from tidewright.llm.graph import components
from tidewright.llm.simhash import fingerprint_links, near_duplicates

from llm_cases import SF, awkward, nothing  # noqa: F401


def fingerprint(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    prints = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    low = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            low[find(p)] = min(d, low.get(find(p), d))
    return sorted((str(d), p, str(low.get(find(p)))) for (d, _), p in zip(rows, prints))


def got(df):
    return sorted((str(r.doc_id), r.fingerprint_bits % (1 << 64), str(r.component_id)) for r in df.collect())


def test_documents_beside_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(near_duplicates(docs)) == brute(rows)


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = near_duplicates(awkward.withColumnRenamed("kept", "component_ID"))
    assert got(found) == brute(rows)
    assert found.columns == ["doc_id", "bucket", "fingerprint_bits", "component_id"]
    assert near_duplicates(nothing).count() == 0


def test_links_lose_nothing(spark):
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(200)} | {0, 2**64 - 1}
    for v in list(values)[:150]:  # balls around some, with differences anywhere
        for _ in range(12):
            values.add(v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    values |= {5 ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    found = {tuple(sorted((r.a % 2**64, r.b % 2**64))) for r in
             fingerprint_links(spark.createDataFrame(signed, "bits long"), bucket_rows=500).collect()}
    every = sorted(values)
    want = {(a, b) for i, a in enumerate(every) for b in every[i + 1:] if (a ^ b).bit_count() <= 2}
    assert found == want


def test_components_of_chains_and_stars(spark):
    rng = random.Random(7)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + k) for k in range(1, 40)]
    loose = [(200 + 2 * k, 201 + 2 * k) for k in range(20)]
    links = [(min(p), max(p)) for p in chain + star + loose]
    rng.shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{100 + k: 100 for k in range(40)},
                     **{200 + k: 200 + k // 2 * 2 for k in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
