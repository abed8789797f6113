"""Runs of words beside a search through every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from llm_cases import SF, awkward, nothing  # noqa: F401
from tidewright.llm.periodic import Extensions, difference_cover, find_runs, runs_of
from tidewright.llm.queries import QUERIES


def plain_runs(words, exponent=4, least=6):
    found, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sequence(rng):
    n, k = rng.choice([0, 1, 5, 6, 7, 20, 60, 200]), rng.choice([1, 2, 3, 50])
    words = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("every", [1, 2, 3, 7, 13, 21])
def test_two_places_always_meet_samples(every):
    chosen, member = difference_cover(every)
    assert all((member[d] + d) % every in chosen for d in range(every))


def test_extensions_beside_plain_version():
    rng = random.Random(5)
    for _ in range(60):
        line = [rng.randrange(2) for _ in range(rng.randint(2, 150))] + [9]
        ask = Extensions(np.array(line), np.zeros(len(line), int), rng.choice([1, 3, 7, 21]))
        pairs = [tuple(sorted(rng.sample(range(len(line)), 2))) for _ in range(50)]
        got = ask.ask(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])).tolist()
        for (a, b), n in zip(pairs, got):
            assert line[a:a + n] == line[b:b + n] and line[a + n] != line[b + n]


def test_runs_beside_plain_version():
    rng = random.Random(1)
    for _ in range(400):
        texts = [sequence(rng) for _ in range(rng.randint(1, 5))]
        exponent, least = rng.choice([(4, 6), (4, 6), (2, 2), (3, 9)])
        got = runs_of(np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts]), exponent, least)
        assert [tuple(r) for r in got.tolist()] == [
            (d, *r) for d, t in enumerate(texts) for r in plain_runs(t, exponent, least)]


def test_long_texts_of_few_words():
    equal = runs_of(np.zeros(200_000, int), np.array([200_000]))
    assert equal.tolist() == [[0, 0, 200_000, 1]]
    two = np.tile(np.append(np.zeros(49_999, int), 1), 4)
    assert [0, 0, 200_000, 50_000] in runs_of(two, np.array([200_000])).tolist()


def test_query_beside_plain_version(spark):
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    many = 0
    for doc in docs:
        words, h = words_in(doc.text), zlib.crc32(str(doc.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs, r = plain_runs(words), rows[doc.doc_id]
        many += len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_kept(words, runs).encode()).hexdigest()
    assert many > 5


def test_awkward_rows(spark, awkward, nothing):
    found = find_runs(awkward.withColumnRenamed("kept", "runs")).collect()
    assert len(found) == awkward.count()
    for r in found:
        words = words_in(r.text)
        want = [(0, 9000, 1)] if len(words) == 9000 else plain_runs(words)
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(words)
        assert r.collapsed == plain_kept(words, want)
    assert find_runs(nothing).count() == 0
    assert find_runs(nothing).columns == ["doc_id", "text", "kept", "bucket", "n_words", "runs", "collapsed"]
