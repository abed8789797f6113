"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word goes in as two vectors: one of the word itself (hashed) and the mean of those of
its character pieces, so an unseen ending of a known stem still speaks. All overlapping
windows of a text are scored; the text's score is that of its worst window. The network
is trained on a bounded sample of labelled texts, whole, window by window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from .common import U, joined, mixed, ship, slices, text_bytes, with_fields, without, word_hashes

# Bytes that are part of a word here: letters and digits, and any character beyond ASCII
PART = np.zeros(256, bool)
PART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LONGEST = 40
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass(frozen=True)
class Shape:
    words: int = 1 << 14      # hashed vectors of words
    pieces: int = 1 << 15     # hashed vectors of character pieces
    inputs: int = 16          # length of both
    hidden: int = 8           # units in each direction
    window: int = 24          # words in a window
    step: int = 12            # words from one window to the next
    sizes: tuple[int, ...] = (3, 4, 5)  # characters (bytes) in a piece


def words_in(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes of all texts, begin and end of each word, words of each text. A word
    over LONGEST bytes, as in scripts without spaces, is cut into words that overlap by half."""
    texts = [t.lower() if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts]
    data, begins, _ = joined(texts)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = PART[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    starts, ends = _cut_long(data, starts, ends)
    return data, starts, ends, np.diff(np.append(np.searchsorted(starts, begins), len(starts)))


def _cut_long(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of at most LONGEST bytes, and a few more where a character would be cut."""
    stride = LONGEST // 2
    number = np.maximum(0, -(-(ends - starts - LONGEST) // stride)) + 1
    of = np.repeat(np.arange(len(starts)), number)
    k = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    begin = starts[of] + k * stride
    end = np.minimum(begin + LONGEST, ends[of])

    def whole(at: np.ndarray) -> np.ndarray:
        for _ in range(3):
            at = at - (data[np.minimum(at, len(data) - 1)] & 0xC0 == 0x80)
        return at

    return whole(begin), whole(end)


def piece_table(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the character pieces of each word, in turn, and how many each has. Pieces
    know where a word begins and ends."""
    size = ends - starts
    total = int((size + 2).sum())
    begins = np.cumsum(size + 2) - (size + 2)
    line = np.full(total + max(shape.sizes), 1, np.uint64)
    of = np.repeat(np.arange(len(starts)), size)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    line[begins[of] + 1 + inner] = data[starts[of] + inner]
    line[begins + size + 1] = 2
    numbers, owner = [], []
    room = size + 2
    for n in shape.sizes:
        count = np.maximum(room - n + 1, 0)
        of = np.repeat(np.arange(len(starts)), count)
        at = np.repeat(begins, count) + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        key = np.full(len(at), n, U)
        for k in range(n):
            key = key * U(0x100000001B3) + line[at + k]
        numbers.append((mixed(key) % U(shape.pieces)).astype(np.int64))
        owner.append(of)
    numbers, owner = np.concatenate(numbers), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return numbers[order], np.bincount(owner, minlength=len(starts))


def sums_of(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers in `index`, and the sum of the rows of each."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    first = np.flatnonzero(np.diff(index, prepend=-1))
    return index[first], np.add.reduceat(values[order], first, axis=0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights by name: word and piece vectors; per direction the input (Wx), state (Wh) and
    bias (b) of the update, reset and candidate gates; attention (A, a, v); output (o, c)."""

    shape: Shape
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, shape: Shape, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        e, h = shape.inputs, shape.hidden

        def draw(*size: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(size) * scale).astype(np.float32)

        w = {"word": draw(shape.words, e, scale=0.05), "piece": draw(shape.pieces, e, scale=0.05)}
        for d in "fb":
            w |= {f"{d}Wx": draw(2 * e, 3 * h, scale=0.2), f"{d}Wh": draw(h, 3 * h, scale=0.3), f"{d}b": np.zeros(3 * h, np.float32)}
        w |= {"A": draw(2 * h, h, scale=0.3), "a": np.zeros(h, np.float32), "v": draw(h, scale=0.5),
              "o": draw(2 * h, scale=0.3), "c": np.zeros(1, np.float32)}
        return cls(shape, w)

    def inputs(self, words: np.ndarray, pieces: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One row per different word: its own vector, and the mean of its pieces'."""
        w = self.weights
        found = np.zeros((len(words), 2 * self.shape.inputs), np.float32)
        found[:, :self.shape.inputs] = w["word"][words]
        if len(pieces):
            filled = np.flatnonzero(counts)
            first = (np.cumsum(counts) - counts)[filled]
            found[filled, self.shape.inputs:] = np.add.reduceat(w["piece"][pieces], first, axis=0) / counts[filled, None]
        return found

    def run(self, projected: dict[str, np.ndarray], rows: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Probabilities of windows. `rows` (windows, words) points into `projected`, the
        inputs of both directions times Wx; `mask` tells the words that are there."""
        w, h = self.weights, self.shape.hidden
        n, t = rows.shape
        states = np.zeros((t, n, 2 * h), np.float32)
        memory = {"f": [], "b": []}
        for d, order, part in (("f", range(t), slice(0, h)), ("b", range(t - 1, -1, -1), slice(h, 2 * h))):
            state = np.zeros((n, h), np.float32)
            for k in order:
                x = projected[d][rows[:, k]]
                gates = sigmoid(x[:, :2 * h] + state @ w[f"{d}Wh"][:, :2 * h])
                update, reset = gates[:, :h], gates[:, h:]
                inner = (reset * state) @ w[f"{d}Wh"][:, 2 * h:]
                new = np.tanh(x[:, 2 * h:] + inner)
                here = mask[:, k, None]
                after = state + here * update * (new - state)
                if keep:
                    memory[d].append((k, state, update, reset, new, here))
                state = after
                states[k, :, part] = state
        hidden = np.tanh(states @ w["A"] + w["a"])
        logits = np.where(mask.T > 0, hidden @ w["v"], -30).astype(np.float32)
        share = np.exp(logits - logits.max(0))
        share *= mask.T
        share /= np.maximum(share.sum(0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", share, states)
        odds = pooled @ w["o"] + w["c"][0]
        if not keep:
            return sigmoid(odds)
        return sigmoid(odds), (states, hidden, share, pooled, memory)

    def project(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {d: inputs @ self.weights[f"{d}Wx"] + self.weights[f"{d}b"] for d in "fb"}

    def gradients(self, inputs: np.ndarray, rows: np.ndarray, mask: np.ndarray, truth: np.ndarray, weight: np.ndarray):
        """Loss, and its slope by every weight but the vectors, and by the inputs."""
        w, h = self.weights, self.shape.hidden
        projected = self.project(inputs)
        score, (states, hidden, share, pooled, memory) = self.run(projected, rows, mask, keep=True)
        loss = -float((weight * np.log(np.where(truth > 0, score, 1 - score) + 1e-7)).sum())
        odds = ((score - truth) * weight).astype(np.float32)
        g = {"o": pooled.T @ odds, "c": odds.sum(keepdims=True)}
        d_pool = odds[:, None] * w["o"]
        d_states = share[:, :, None] * d_pool[None]
        d_share = np.einsum("tnh,nh->tn", states, d_pool)
        d_logit = share * (d_share - (share * d_share).sum(0))
        d_hidden = d_logit[:, :, None] * w["v"] * (1 - hidden**2)
        g["v"] = np.einsum("tn,tnh->h", d_logit, hidden)
        g["A"] = np.einsum("tni,tnj->ij", states, d_hidden)
        g["a"] = d_hidden.sum((0, 1))
        d_states += d_hidden @ w["A"].T
        d_inputs = np.zeros_like(inputs)
        for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            slopes = np.zeros((rows.shape[1], len(rows), 3 * h), np.float32)
            wh = w[f"{d}Wh"]
            g[f"{d}Wh"] = np.zeros_like(wh)
            back = np.zeros((len(rows), h), np.float32)
            for k, state, update, reset, new, here in reversed(memory[d]):
                d_after = d_states[k][:, part] + back
                d_update = d_after * here * (new - state) * update * (1 - update)
                d_new = d_after * here * update * (1 - new**2)
                d_mixed = d_new @ wh[:, 2 * h:].T
                d_reset = d_mixed * state * reset * (1 - reset)
                gates = np.concatenate([d_update, d_reset], 1)
                g[f"{d}Wh"][:, :2 * h] += state.T @ gates
                g[f"{d}Wh"][:, 2 * h:] += (reset * state).T @ d_new
                back = d_after * (1 - here * update) + gates @ wh[:, :2 * h].T + d_mixed * reset
                slopes[k, :, :2 * h], slopes[k, :, 2 * h:] = gates, d_new
            d_projected = np.zeros_like(projected[d])
            which, total = sums_of(rows.T.ravel(), slopes.reshape(-1, 3 * h))
            d_projected[which] = total
            g[f"{d}Wx"] = inputs.T @ d_projected
            g[f"{d}b"] = d_projected.sum(0)
            d_inputs += d_projected @ w[f"{d}Wx"].T
        return loss, g, d_inputs


def windows_of(counts: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, words) places in the joined texts, their mask, and each window's text. Every
    word is in a window; a text without words has one, empty."""
    number = np.maximum(1, -(-np.maximum(counts - shape.window, 0) // shape.step) + 1)
    text = np.repeat(np.arange(len(counts)), number)
    k = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    first = (np.cumsum(counts) - counts)[text]
    at = k[:, None] * shape.step + np.arange(shape.window)
    mask = at < counts[text][:, None]
    return np.where(mask, first[:, None] + at, 0), mask.astype(np.float32), text


class Prepared:
    """Texts as numbers: the different words among them, with their pieces, and each place's word."""

    def __init__(self, texts: list[bytes], shape: Shape):
        data, starts, ends, self.counts = words_in(texts)
        hashes = word_hashes(data, starts, ends)
        different, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        self.place = place if len(place) else np.zeros(1, np.int64)
        self.words = (different % U(shape.words)).astype(np.int64)
        self.pieces, self.piece_counts = piece_table(data, starts[first], ends[first], shape)
        if not len(different):  # one word that no window shows
            self.words, self.pieces, self.piece_counts = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)


def score_texts(network: Network, texts: list[bytes], block: int = 4096) -> np.ndarray:
    """The highest probability over all windows of each text."""
    shape = network.shape
    ready = Prepared(texts, shape)
    projected = network.project(network.inputs(ready.words, ready.pieces, ready.piece_counts))
    best = np.zeros(len(texts))
    at, mask, text = windows_of(ready.counts, shape)
    for k in range(0, len(at), block):
        part = slice(k, k + block)
        np.maximum.at(best, text[part], network.run(projected, ready.place[at[part]], mask[part]))
    return best


def train(texts: list[bytes], labels: np.ndarray, shape: Shape = Shape(), rounds: int = 8, batch: int = 512, rate: float = 0.01,
          per_text: int = 6, seed: int = 7) -> Network:
    """Trains on windows of the texts. A text is toxic if one of its windows is, and nobody
    says which. In the first two rounds every window has its text's label, so that words
    common to both labels cancel out. From then on a toxic text stands for the windows the
    network finds worst in it, and a clean one for `per_text` windows, its worst among them.
    """
    network = Network.fresh(shape, seed)
    if not len(texts):
        return network
    rng = np.random.default_rng(seed)
    ready = Prepared(texts, shape)
    at, mask, text = windows_of(ready.counts, shape)
    at = ready.place.astype(np.int32)[at]
    bad = labels[text] > 0
    truth = bad.astype(np.float32)
    first_piece = np.cumsum(ready.piece_counts) - ready.piece_counts
    mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
    square = {k: np.zeros_like(v) for k, v in network.weights.items()}
    steps = 0
    for turn in range(rounds):
        drawn = _places(text, rng.random(len(at))) < per_text
        if turn < 2:
            use = drawn
        else:
            projected = network.project(network.inputs(ready.words, ready.pieces, ready.piece_counts))
            score = np.concatenate([network.run(projected, at[k:k + 2048], mask[k:k + 2048]) for k in range(0, len(at), 2048)])
            worst = _places(text, -score)
            use = np.where(bad, (worst < 1) | ((worst < per_text) & (score >= 0.7)), drawn | (worst < 2))
        chosen = rng.permutation(np.flatnonzero(use))
        for k in range(0, len(chosen), batch):
            part = chosen[k:k + batch]
            different, rows = np.unique(at[part], return_inverse=True)
            rows = rows.reshape(at[part].shape)
            counts = ready.piece_counts[different]
            of = np.repeat(np.arange(len(different)), counts)
            pieces = ready.pieces[np.repeat(first_piece[different], counts) + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)]
            inputs = network.inputs(ready.words[different], pieces, counts)
            weight = np.full(len(part), 1 / len(part), np.float32)
            _, g, d_inputs = network.gradients(inputs, rows, mask[part], truth[part], weight)
            steps += 1
            speed = rate * (1 - 0.9 * turn / rounds) * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            for name, slope in g.items():
                _adam(network.weights[name], mean[name], square[name], slope, speed, ...)
            e = shape.inputs
            for name, numbers, slope in (("word", ready.words[different], d_inputs[:, :e]),
                                         ("piece", pieces, (d_inputs[:, e:] / np.maximum(counts, 1)[:, None])[of])):
                if len(numbers):
                    which, total = sums_of(numbers, slope)
                    _adam(network.weights[name], mean[name], square[name], total, speed, which)
    return network


def _places(group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The place of each entry within its group (groups stand together) by `order`."""
    sorted_ = np.lexsort((order, group))
    first = np.flatnonzero(np.diff(group, prepend=-1))
    places = np.empty(len(group), np.int64)
    places[sorted_] = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
    return places


def _adam(weight, mean, square, slope, speed: float, rows) -> None:
    """One step of Adam on some rows."""
    m = mean[rows] * 0.9 + 0.1 * slope
    s = square[rows] * 0.999 + 0.001 * slope * slope
    mean[rows], square[rows] = m, s
    weight[rows] -= (speed * m / (np.sqrt(s) + 1e-8)).astype(np.float32)


def held_out(id_col: Column) -> Column:
    """Whether labels of a row may not be learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int,
                  text_bytes_most: int) -> tuple[list[bytes], np.ndarray]:
    """Texts and labels to learn from, never held-out ones: up to a quarter of
    `rows` toxic ones, and three quarters clean ones, the first in the order of a hash of the id, so the choice does not depend on how the
    tables lie; texts over `text_bytes_most` are not chosen. Bounded by the two numbers;
    rows are joined with a bounded choice of ids, so the texts of others never move."""
    key = F.col(f"`{id_col}`").cast("bigint")
    known = labels.select(key.alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter(
        "label in (0, 1) and id is not null").filter(~F.coalesce(held_out(F.col("id")), F.lit(True)))
    order = F.xxhash64("id")
    picked = None
    for label, most in ((0, rows * 3 // 4), (1, rows // 4)):
        part = known.filter(F.col("label") == label).distinct().orderBy(order, "id").limit(most)
        picked = part if picked is None else picked.union(part)
    found = (docs.select(key.alias("id"), F.col(f"`{text_col}`").alias("text"))
             .filter(F.octet_length("text") <= text_bytes_most)
             .join(F.broadcast(picked), "id").dropDuplicates(["id"]).orderBy("id").collect())
    return [r["text"].encode() for r in found], np.array([r["label"] for r in found], np.int8)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          rows: int = 3000, text_bytes_most: int = 8_000, shape: Shape = Shape(), **options) -> Network:
    """A network trained on a bounded sample: at most `rows` labelled texts of at most
    `text_bytes_most` bytes, whole. No label, or no labelled text: an untrained network."""
    ship(docs)
    texts, truth = training_rows(docs, labels, id_col, text_col, label_col, rows, text_bytes_most)
    return train(texts, truth, shape, **options)


def score(docs: DataFrame, network: Network, text_col: str = "text", score_col: str = "score", chunk_bytes: int = 512 << 10) -> DataFrame:
    """`docs` with the toxicity of its text, 0 to 1. The network (a few MB whatever the data)
    is sent to all executors; rows never move.

    Nulls: a null text is empty; an empty text gets the score of an empty window. Repeated
    rows: equal texts, equal scores. Empty table: no rows. A column of `docs` called like
    the new one is replaced.
    """
    ship(docs)
    docs = without(docs, score_col)
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, chunk_bytes):
            found = score_texts(sent.value, text_bytes(batch.column(text_col)))
            yield pa.record_batch([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(run, with_fields(docs, f"`{score_col}` double"))
