"""Suffix-array and FM-index dedup beside brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from llm_cases import awkward, nothing  # noqa: F401
from tidewright.llm.fmindex import FMIndex, remove_repeated_words
from tidewright.llm.suffix import remove_repeated_bytes, two_stage

WORD = r"[^\x20\x09-\x0D]+"
LIMITS = [{}, {"chunk_bytes": 3000, "bucket_bytes": 2000}, {"chunk_bytes": 3000, "bucket_bytes": 4000, "hot": 2, "longest": 16}]


def documents():
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(12)]
    base = [" ".join(rng.choice(voc) for _ in range(rng.randint(0, 160))) for _ in range(12)]
    docs = []
    for i in range(70):
        k = rng.random()
        a, b = rng.choice(base), rng.choice(base)
        if k < 0.2:
            t = a
        elif k < 0.6:
            t = a[:rng.randint(0, len(a))] + f" q{i} é " + b[rng.randint(0, len(b)):]
        elif k < 0.7:
            t = "ab " * rng.randint(0, 200)
        elif k < 0.75:
            t = "a" * rng.randint(0, 900)
        elif k < 0.8:
            t = None
        else:
            t = " ".join(rng.choice(voc) for _ in range(rng.randint(0, 100)))
        docs.append((i, t))
    return docs + [(3, docs[3][1]), (3, "x" + "yz" * 80), (None, docs[5][1]), (None, docs[5][1]), (None, "p" * 150)]


def brute_bytes(rows, length=100):
    def key(row):
        return row[0] if row[0] is not None else 2**63, xxhash.xxh3_64_intdigest((row[1] or "").encode()) & 0xFFFFFFFF

    seen, out = set(), []
    for d, t in sorted(rows, key=key):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(b[i:i + length])
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out.append((str(d), len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def brute_words(rows, length=35):
    texts = [re.findall(WORD, t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + length]) for w in texts for i in range(len(w) - length + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        gone = [0] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [1] * length
        kept = " ".join(x for x, y in zip(w, gone) if not y)
        out.append((str(d), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got_bytes(df):
    return sorted((str(r.doc_id), r.n_bytes, sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])), len(r.spans) // 2,
                   hashlib.sha256(r.kept).hexdigest()) for r in df.collect())


def got_words(df):
    return sorted((str(r.doc_id), r.n_words, sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])),
                   hashlib.sha256(" ".join(re.findall(WORD, r.kept)).encode()).hexdigest()) for r in df.collect())


@pytest.mark.parametrize("limits", LIMITS)
def test_bytes_beside_brute_force(spark, limits):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got_bytes(remove_repeated_bytes(df, **limits)) == brute_bytes(rows)


@pytest.mark.parametrize("limits", LIMITS)
def test_words_beside_brute_force(spark, limits):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got_words(remove_repeated_words(df, **limits)) == brute_words(rows)


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = remove_repeated_bytes(awkward)
    assert got_bytes(found) == brute_bytes(rows)
    assert found.columns == ["doc_id", "text", "bucket", "n_bytes", "spans", "kept"]
    assert got_words(remove_repeated_words(awkward)) == brute_words(rows)
    assert remove_repeated_bytes(nothing).count() == remove_repeated_words(nothing).count() == 0


def test_two_stage_order():
    rng = np.random.default_rng(3)
    for alphabet in (1, 2, 5, 256):
        text = rng.integers(0, alphabet, 700).astype(np.uint8)
        order = two_stage(text, np.ones(len(text), bool), 64)
        raw = text.tobytes() + b"\0" * 200
        want = sorted(range(len(text)), key=lambda i: text.tobytes()[i:])
        if alphabet == 256:
            assert order.tolist() == want
        assert [raw[i:i + 60] for i in order[order < 600]] == sorted(raw[i:i + 60] for i in range(600))


def test_matching_statistics():
    rng = np.random.default_rng(4)
    parts = [rng.integers(1, 4, n) for n in (40, 25, 60, 1)]
    text = np.concatenate([x for p in parts for x in ([0], p)] + [[0]]).astype(np.int64)
    index = FMIndex(text, 6)
    begin = np.cumsum([1, *(len(p) + 1 for p in parts[:-1])])
    end = begin + [len(p) for p in parts]
    found = index.matching(text, begin, end)
    flat = text.tolist()
    for a, b in zip(begin, end):
        for i in range(a, b):
            best = 0
            for n in range(1, min(6, b - i) + 1):
                want = flat[i:i + n]
                if sum(flat[j:j + n] == want for j in range(len(flat) - n + 1)) >= 2:
                    best = n
            assert found[i] == best
