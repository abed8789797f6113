"""Quality rules by weak supervision.

Each rule votes good, bad or abstains. Nobody knows which rules are right, so
expectation-maximisation estimates how often each rule votes each way on good and on
bad texts, from all texts at once; the posterior probability that a text is good
replaces "passes every rule". Only counts of equal vote patterns are needed: at most
3 to the number of rules, however many texts there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import IS_SPACE, fresh, ship, slices, text_bytes, with_fields, without, word_spans

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_top_pairs",
         "n_upper_words", "n_lines", "n_marked_words"]
ENDS = np.zeros(256, bool)  # bytes that end many words of junk, and of few others
ENDS[[ord(c) for c in "!?#*$%&|<>=~^"]] = True


def repeated_words(numbers: np.ndarray, size: int = 3) -> int:
    """Words inside windows of `size` words that stand twice or more in the text."""
    n = len(numbers) - size + 1
    if n < 2:
        return 0
    key, top = numbers[:n].astype(np.int64), int(numbers.max()) + 1
    for k in range(1, size):
        _, key = np.unique(key * top + numbers[k:k + n], return_inverse=True)
    many = np.bincount(key)[key] > 1
    cover = np.zeros(len(numbers) + 1, np.int64)
    at = np.flatnonzero(many)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    return int(np.count_nonzero(np.cumsum(cover[:-1])))


def measure(text: bytes) -> tuple[int, ...]:
    """The numbers of STATS for one text."""
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(data)
    n = len(starts)
    lines = text.split(b"\n")
    seen, repeats, filled = set(), 0, 0
    for line in lines:
        if line.strip(b" \t\n\x0b\x0c\r"):
            filled += 1
            if line in seen:
                repeats += 1
            seen.add(line)
    if not n:
        return (0,) * len(STATS)
    words = re.findall(rb"[^\x20\x09-\x0D]+", text)
    known: dict[bytes, int] = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    same_as_next = int(np.count_nonzero(numbers[1:] == numbers[:-1]))
    first, last = data[starts], data[ends - 1]
    upper = sum(1 for w in words if w.isupper()) if (first < 97).mean() > 0.2 else 0
    characters = int(np.count_nonzero((data & 0xC0) != 0x80)) - int(np.count_nonzero(IS_SPACE[data]))
    marked = int(np.count_nonzero(ENDS[last]))
    return (n, characters, int(np.count_nonzero(SYMBOLS[data])), repeats, repeated_words(numbers), len(known),
            same_as_next, upper, filled, marked)


def statistics(docs: DataFrame, text_col: str = "text", chunk_bytes: int = 4 << 20) -> DataFrame:
    """`docs` without the text, with the numbers of STATS. A null text has no words."""
    ship(docs)
    schema = with_fields(without(docs, text_col, *STATS), ", ".join(f"{s} bigint" for s in STATS))
    rest = schema.names[:-len(STATS)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, chunk_bytes):
            found = np.array([measure(t) for t in text_bytes(batch.column(text_col))], np.int64).reshape(-1, len(STATS))
            yield pa.record_batch([*(batch.column(c) for c in rest), *(pa.array(found[:, k]) for k in range(len(STATS)))],
                                  names=schema.names)

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class QualityRule:
    """Votes bad where `bad` holds, else good where `good` holds, else abstains. Most rules
    know one kind of junk, and have nothing to say about texts without it."""

    name: str
    bad: str = "false"
    good: str = "false"


RULES = [
    QualityRule("symbols", bad="n_symbols > 0.1 * n_words"),
    QualityRule("marked", bad="n_marked_words > 0.3 * n_words"),
    QualityRule("shouting", bad="n_upper_words > 0.5 * n_words"),
    QualityRule("stutter", bad="n_top_pairs > 0.15 * n_words"),
    QualityRule("repeats", bad="n_repeat_words > 0.3 * n_words"),
    QualityRule("lines", bad="n_dup_lines > 0.3 * n_lines and n_dup_lines >= 3"),
    QualityRule("variety", bad="n_distinct < 0.2 * n_words and n_words < 2000"),
    QualityRule("length", bad="word_chars < 2 * n_words or word_chars > 15 * n_words",
                good="word_chars between 3 * n_words and 12 * n_words"),
    QualityRule("prose", good="n_symbols <= 0.02 * n_words and n_marked_words <= 0.1 * n_words and n_upper_words <= 0.2 * n_words"),
    QualityRule("fresh", good="n_repeat_words <= 0.25 * n_words and n_top_pairs <= 0.05 * n_words "
                              "and (n_distinct >= 0.3 * n_words or n_words >= 2000)"),
]
# Where the estimate starts: how likely a rule votes bad, abstains, votes good on bad and on
# good texts, if it can vote that way at all
START = np.array([[0.35, 0.55, 0.10], [0.02, 0.48, 0.50]])
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def votes(rules: list[QualityRule] = RULES) -> Column:
    """One array of votes: 2 good, 1 abstained, 0 bad."""
    return F.array(*(F.expr(f"case when {r.bad} then 0 when {r.good} then 2 else 1 end") for r in rules))


@dataclass(frozen=True)
class VoteModel:
    """Share of good texts and, per rule, the logarithms of how likely each vote is on bad
    and on good texts."""

    prior: float
    logs: np.ndarray  # rules, (bad, good), votes

    def posterior(self, votes: Column) -> Column:
        """Probability that a text with these votes is good. An array per vote keeps it
        inside Spark."""
        gap = self.logs[:, 1] - self.logs[:, 0]
        terms = [F.element_at(F.array(*(F.lit(float(x)) for x in row)), votes[k] + 1) for k, row in enumerate(gap)]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(float(np.log(self.prior) - np.log1p(-self.prior))))))


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 1.0) -> VoteModel:
    """Expectation-maximisation over vote patterns. It starts from "votes are mostly
    right", and a vote that would come out likelier on the wrong side is held at equal
    chances, so good and bad cannot change places. Counts are smoothed by the start; no
    text at all gives the start.
    """
    n_rules = patterns.shape[1]
    total = max(1.0, float(counts.sum()))
    hot = np.eye(3)[patterns]  # patterns, rules, votes
    cast = hot.any(0) if len(patterns) else np.ones((n_rules, 3), bool)
    prior = 0.8
    start = START * np.maximum(cast[:, None, :], 1e-6)
    start /= start.sum(2, keepdims=True)
    like = start
    for _ in range(rounds):
        score = np.einsum("prv,rcv->pc", hot, np.log(like)) + np.log([1 - prior, prior])
        good = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -700, 700)))
        weight = np.stack([(1 - good) * counts, good * counts], 1)
        prior_new = float(np.clip((weight[:, 1].sum() + smooth) / (total + 2 * smooth), 0.05, 0.95))
        new = np.einsum("prv,pc->rcv", hot, weight) + smooth * start
        new /= new.sum(2, keepdims=True)
        for vote, wrong, right in ((0, 1, 0), (2, 0, 1)):
            turned = new[:, wrong, vote] > new[:, right, vote]
            mean = (new[:, wrong, vote] + new[:, right, vote]) / 2
            new[turned, wrong, vote] = new[turned, right, vote] = mean[turned]
        new /= new.sum(2, keepdims=True)
        done = np.abs(new - like).max() < 1e-9 and abs(prior - prior_new) < 1e-9
        prior, like = prior_new, new
        if done:
            break
    return VoteModel(prior, np.log(like))


def learn(stats: DataFrame, rules: list[QualityRule] = RULES) -> VoteModel:
    """The model of all texts whose numbers are in `stats`. What reaches the driver is at
    most 3 to the number of rules rows of counts, summed map-side first."""
    rows = stats.groupBy(votes(rules).alias("votes")).count().collect()
    patterns = np.array([r["votes"] for r in rows], int).reshape(-1, len(rules))
    return fit(patterns, np.array([r["count"] for r in rows], float))


def judged(stats: DataFrame, model: VoteModel, rules: list[QualityRule] = RULES, threshold: float = 0.5) -> DataFrame:
    """`stats` with quality (the posterior), base_failed and kept: not failed by the base
    rules (few words, mostly repeats) and good with probability `threshold` or more."""
    scored = without(stats, "quality", "base_failed", "kept").withColumns({
        "quality": model.posterior(votes(rules)), "base_failed": F.expr(BASE_FAILED)})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def filter_quality(docs: DataFrame, text_col: str = "text", model: VoteModel | None = None, rules: list[QualityRule] = RULES,
                   threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that are kept, with its columns. Texts are read twice, once for
    the votes and once to filter; only texts go through Python, and their numbers come back.

    Nulls: a null text has no words and goes; other columns do not matter. Repeated rows:
    equal texts get equal verdicts. Empty table: no rows. Clashing names cannot occur:
    numbers travel in one column with a new name.
    """
    ship(docs)
    if model is None:
        model = learn(statistics(docs.select(F.col(f"`{text_col}`").alias("text"))), rules)
    numbers = fresh(docs, "__text_numbers")

    @F.arrow_udf(returnType=f"struct<{', '.join(f'{s}: bigint' for s in STATS)}>")
    def measured(texts: pa.Array) -> pa.Array:
        found = np.array([measure(t) for t in text_bytes(texts)], np.int64).reshape(-1, len(STATS))
        return pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(STATS))], names=STATS)

    inside = [QualityRule(r.name, _within(r.bad, numbers), _within(r.good, numbers)) for r in rules]
    keep = ~F.expr(_within(BASE_FAILED, numbers)) & (model.posterior(votes(inside)) >= threshold)
    return docs.withColumn(numbers, measured(F.col(f"`{text_col}`"))).filter(keep).drop(numbers)


def _within(condition: str, struct: str) -> str:
    return re.sub(r"\b(" + "|".join(STATS) + r")\b", rf"`{struct}`.\1", condition)
