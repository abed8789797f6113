"""Quality votes, string tiling, toxicity and chat formatting beside plain versions of them."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_cases import SF, awkward, nothing  # noqa: F401
from tidewright.llm import quality, toxicity
from tidewright.llm.chat import assemble, digest_chat, format_chat
from tidewright.llm.decontam import contaminated, decontaminate, tile
from tidewright.llm.queries import QUERIES

WORD = r"[^\x20\x09-\x0D]+"


# quality

def plain_numbers(text):
    text = text or ""
    words = re.findall(WORD, text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dups += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


def test_numbers_beside_plain_version(spark, awkward):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(awkward.select("doc_id", "text"))
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                    for r in quality.statistics(docs).collect())
    assert found == Counter((d, *plain_numbers(t)) for (d, t), n in texts.items() for _ in range(n))


def test_votes_agree_with_labels(spark):
    sf = SF.replace("0.001", "0.01")
    rows = QUERIES["op1_quality_rules"](spark, sf).withColumnRenamed("quality", "chance").join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    judged = [r for r in rows if not r.base_failed]
    assert sum(r.kept for r in judged if r.quality == 1) >= 0.99 * sum(r.quality for r in judged)
    assert sum(not r.kept for r in judged if r.quality == 0) >= 0.9 * sum(1 - r.quality for r in judged)
    assert not any(r.kept for r in rows if r.base_failed)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)


def test_posterior_is_the_models(spark):
    rng = np.random.default_rng(1)
    patterns = rng.integers(0, 3, (30, len(quality.RULES)))
    model = quality.fit(patterns, rng.integers(1, 50, 30).astype(float))
    df = spark.createDataFrame([(p.tolist(),) for p in patterns], "v array<int>")
    from pyspark.sql import functions as F
    found = [r[0] for r in df.select(model.posterior(F.col("v"))).collect()]
    odds = np.log(model.prior / (1 - model.prior)) + np.array(
        [sum(model.logs[k, 1, v] - model.logs[k, 0, v] for k, v in enumerate(p)) for p in patterns])
    assert np.allclose(found, 1 / (1 + np.exp(-odds)))


def test_filter_keeps_columns_and_survives_nothing(spark, awkward, nothing):
    kept = quality.filter_quality(awkward)
    assert kept.columns == awkward.columns and kept.count() <= awkward.count()
    assert quality.filter_quality(nothing).count() == 0
    assert quality.judged(quality.statistics(nothing), quality.learn(quality.statistics(nothing))).count() == 0


# string tiling

def words(n, rng):
    return [f"{rng.choice('bcdfg')}{rng.randrange(400)}" for _ in range(n)]


def test_tiling_beside_plain_version():
    rng = random.Random(3)
    for _ in range(60):
        a = [rng.randrange(1, 4) for _ in range(rng.randint(0, 40))]
        b = [rng.randrange(1, 4) for _ in range(rng.randint(0, 25))]
        size = rng.randint(2, 5)
        used_a, used_b, want = set(), set(), []
        while True:
            best, hits = size - 1, []
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b):
                        n += 1
                    if n > best:
                        best, hits = n, []
                    if n == best and n >= size:
                        hits.append((i, j))
            if not hits:
                break
            for i, j in hits:
                if not any(i + k in used_a or j + k in used_b for k in range(best)):
                    used_a |= set(range(i, i + best))
                    used_b |= set(range(j, j + best))
                    want.append((i, j, best))
        assert tile(np.array(a, np.uint64), np.array(b, np.uint64), size) == want


def test_long_repeats_take_time_by_length():
    for text, item in ((np.ones(20_000), np.ones(2_000)), (np.tile([1, 2, 3], 5_000), np.tile([1, 2, 3, 4], 300))):
        start = time.perf_counter()
        tiles = tile(text.astype(np.uint64), item.astype(np.uint64), 5)
        assert time.perf_counter() - start < 10
        assert tiles == ([(0, 0, 2_000)] if len(item) == 2_000 else [])


def test_contaminated_beside_plain_version(spark):
    """Every document tiled with every item."""
    rng = random.Random(8)
    items = [(k, " ".join(words(rng.randint(3, 30), rng))) for k in range(12)] + [(3, "a b c d e f a b c d e f")]
    docs = []
    for d in range(80):
        text = words(rng.randint(0, 60), rng)
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(items)[1].split()
            a = rng.randrange(len(piece))
            at = rng.randint(0, len(text))
            text[at:at] = piece[a:a + rng.randint(3, 30)] * rng.choice([1, 1, 2])
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(text).upper() if d % 3 == 0 else " ".join(text)))
    want = set()
    number: dict[str, int] = {}
    plain = lambda text: np.array([number.setdefault(w, len(number)) for w in re.findall(r"[a-z0-9]+", text.lower())], np.uint64)
    for d, text in docs:
        for k, item in items:
            size = len(plain(item))
            covered = sum(t[2] for t in tile(plain(text), plain(item), 5))
            if covered and covered >= 0.6 * size:
                want.add((d, k, covered / size))
    found = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.coverage) for r in found.collect()} == want and len(want) > 20


def leaks(rng):
    items = [(k, words(40, rng)) for k in range(6)] + [(6, ["short", "one"]), (None, words(30, rng))]
    plain = lambda: " ".join(words(200, rng))
    docs, want = [], set()
    for d in range(30):
        k = d % 6
        item = items[k][1]
        if d < 6:  # whole
            docs.append((d, f"{plain()} {' '.join(item)} {plain()}"))
            want.add((d, k))
        elif d < 12:  # its parts in another order, other case and punctuation
            parts = [item[i:i + 10] for i in range(0, 40, 10)]
            rng.shuffle(parts)
            docs.append((d, f"{plain()}\n" + f" {plain()} ".join(", ".join(p).upper() for p in parts)))
            want.add((d, k))
        elif d < 18:  # a quarter of it
            docs.append((d, f"{plain()} {' '.join(item[:10])}"))
        else:
            docs.append((d, plain()))
    docs += [(90, None), (91, ""), (92, "short one"), (None, " ".join(items[0][1])), (0, docs[0][1])]
    return docs, [(k, " ".join(w)) for k, w in items] + [(9, None), (8, "")], want


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 300, "chunk_bytes": 1000}])
def test_leaks_are_found(spark, limits):
    docs, items, want = leaks(random.Random(8))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    found = contaminated(docs, items, **limits).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want | {(None, 0)}
    assert sum(r.doc_id == 0 for r in found) == 2
    for r in found:
        assert abs(sum(t.words for t in r.tiles) / 40 - r.coverage) < 1e-9
    clean = decontaminate(docs, items, **limits)
    assert {r.doc_id for r in clean.collect()} == {d for d in range(30) if d >= 12} | {90, 91, 92}


def test_no_benchmark_or_no_documents(spark, awkward, nothing):
    items = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(awkward, items).count() == 0
    assert decontaminate(awkward, items).count() == awkward.count()
    full = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert contaminated(nothing, full).count() == 0 and decontaminate(nothing, full).count() == 0


# toxicity

def test_gradients_beside_differences():
    shape = toxicity.Shape(words=32, pieces=32, inputs=3, hidden=2, window=4, step=2)
    net = toxicity.Network.fresh(shape, 1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(2)
    inputs = rng.standard_normal((5, 6))
    rows = rng.integers(0, 5, (3, 4))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 1, 1, 0]], float)
    truth, weight = np.array([1.0, 0, 1]), np.full(3, 0.5)
    _, slopes, d_inputs = net.gradients(inputs, rows, mask, truth, weight)

    def loss():
        return net.gradients(inputs, rows, mask, truth, weight)[0]

    for array, slope in [(net.weights[k], slopes[k]) for k in slopes] + [(inputs, d_inputs)]:
        flat, want = array.reshape(-1), np.asarray(slope).reshape(-1)
        for k in range(0, len(flat), max(1, len(flat) // 5)):
            old = flat[k]
            flat[k] = old + 1e-3
            up = loss()
            flat[k] = old - 1e-3
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-3 - want[k]) < 2e-3


def test_every_word_is_in_a_window():
    shape = toxicity.Shape(window=5, step=2)
    counts = np.array([0, 1, 5, 6, 17])
    at, mask, text = toxicity.windows_of(counts, shape)
    for t, n in enumerate(counts):
        seen = {int(x) for x in at[text == t][mask[text == t] > 0]}
        first = counts[:t].sum()
        assert seen == set(range(first, first + n)) and (text == t).any()


def test_long_words_are_read_to_their_end():
    """Every stretch of 20 bytes stands whole in one of the words; the score sees the end."""
    for text in ("x" * 40, "x" * 41, "".join(chr(97 + k * 7 % 26) for k in range(1001)), "\u6c49" * 14 + "\u5b57\u6bcd" * 300, "a" + "\U0001f600" * 99):
        raw = text.encode()
        data, starts, ends, counts = toxicity.words_in([b"one", raw, b"two"])
        words = [bytes(data[a:b]) for a, b in zip(starts, ends)]
        assert counts.tolist() == [1, len(words) - 2, 1] and words[0] == b"one" and words[-1] == b"two"
        assert all(w.decode() and len(w) <= 43 for w in words)
        step = len(text[-1].encode())
        assert all(any(raw[k:k + 20 - step] in w for w in words) for k in range(len(raw)))
        assert words[1:-1] == [raw] if len(raw) <= 40 else words[-2] == raw[-len(words[-2]):]
    net = toxicity.Network.fresh(toxicity.Shape(), 1)
    one, other = toxicity.score_texts(net, [("\u6c49" * 60 + end).encode() for end in ("\u5b57\u6bcd", "\u6bd2\u6027")])
    same = toxicity.piece_table(*toxicity.words_in([b"q" * 60 + b"slur"])[:3], net.shape)[0]
    assert one != other and set(toxicity.piece_table(*toxicity.words_in([b"slur"])[:3], net.shape)[0]) & set(same)


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op6_toxicity"](spark, sf).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    test = [r for r in rows if r.held_out]
    hit = sum(r.predicted for r in test if r.toxic == 1) / sum(r.toxic for r in test)
    false = sum(r.predicted for r in test if r.toxic == 0) / sum(1 - r.toxic for r in test)
    assert hit >= 0.85 and false <= 0.03
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    network = toxicity.learn(awkward, labels, rounds=1)
    found = toxicity.score(awkward.withColumnRenamed("kept", "Score"), network)
    assert found.columns == ["doc_id", "text", "bucket", "score"]
    rows = found.collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    untrained = toxicity.learn(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(nothing, untrained).count() == 0


# chat

def test_conversations_come_back(spark):
    said = [(1, 0, "user", "a <b> & &lt; </s><s>"), (1, 1, "assistant", "é🙂 <s>user\n"), (1, 1, "assistant", "tie"),
            (1, None, None, None), (2, 0, "assistant", ""), (2, 1, "assistant", None), (None, 0, "odd\nrole</s>", "x"),
            (3, 5, "user", "y" * 30_000), (3, 6, "assistant", "z" * 30_000), (2, 0, "assistant", "")]
    df = spark.createDataFrame([(*r, "extra") for r in said], "conv_id long, turn long, role string, text string, formatted string")
    formatted = format_chat(df)
    want = {}
    for conv in (1, 2, 3, None):
        turns = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in said if r[0] == conv))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        want[conv] = (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest(),
                      len(loss), hashlib.sha256(loss.encode()).hexdigest())
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digest_chat(formatted).collect()}
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in want.items()}
    # ties are ordered by formatted text: "tie" follows "é" there, as in the escaped bytes
    for conv in (2, 3, None):
        assert found[conv] == want[conv]
    for r in formatted.collect():
        assert r.formatted.startswith("<s>") and r.formatted.endswith("</s>")
        assert "<" not in r.formatted[3:-4]
    assert digest_chat(format_chat(df.limit(0))).count() == 0


def test_assembly_copies_every_byte():
    import pyarrow as pa
    column = pa.array(["a", "", "ccc", "ß"]).slice(1, 3)
    text, begins = assemble([b"<", column, b"|", column], 3)
    assert text.to_pylist() == ["<|", "<ccc|ccc", "<ß|ß"]
    assert begins.tolist() == [[0, 1, 1, 2], [0, 1, 4, 5], [0, 1, 3, 4]]
    assert assemble([b"<", pa.array([], pa.string())], 0)[0].to_pylist() == []
