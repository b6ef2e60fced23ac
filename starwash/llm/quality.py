"""Quality rules: counts per text, and an isolation forest on them with a threshold learnt from labels."""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starwash.llm.common import bounded_sample, text_bytes, unwrapped, wrapped
from starwash.sources.staging import stage

BLANKS = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
NOT_WORD_CHARS = BLANKS + bytes(range(0x80, 0xC0))  # blanks, and bytes that continue a code point

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

UPPER = bytes(range(ord("A"), ord("Z") + 1))
PUNCTUATION = string.punctuation.encode()

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_punctuation"]
SCHEMA = ", ".join(f"{c} long" for c in STATISTICS)

TREES = 200
TREE_ROWS = 64  # small, so that many odd rows of one kind do not hide each other
SAMPLE_ROWS = 25_600
SCORE_DIGITS = 4  # of a score where the threshold is set: at most 10,001 scores, however many rows are labelled
MAX_CLEAN_LOSS = 0.002
SEED = 7


def repeated_words(words: list[bytes], length: int = 3) -> int:
    """Words inside a window of ``length`` words that occurs at least twice, its first occurrence included."""
    n = len(words) - length + 1
    if n < 2:
        return 0
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    code = ids[:n]
    for k in range(1, length):
        if k > 1:
            code = np.unique(code, return_inverse=True)[1]  # dense again, so that the next product fits
        code = code * len(known) + ids[k : k + n]
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(length):
        covered[k : k + n] |= again
    return int(covered.sum())


def statistics_of(text: bytes) -> tuple[int, ...]:
    """The counts named in STATISTICS."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text.translate(None, NOT_WORD_CHARS)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(text) - len(text.translate(None, UPPER)),
        len(text) - len(text.translate(None, PUNCTUATION)),
    )


def rule_statistics(column: str = "text") -> Column:
    """Struct of the counts of a text; null counts as empty."""

    @F.pandas_udf(SCHEMA)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([statistics_of(t) for t in texts], columns=STATISTICS, dtype="int64")

    return count(text_bytes(column))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEAT_PERCENT)


def features(stats: np.ndarray) -> np.ndarray:
    """Counts (columns in the order of STATISTICS) to what the trees split on."""
    words, chars = np.maximum(1.0, stats[:, 0]), np.maximum(1.0, stats[:, 1])
    return np.column_stack([
        stats[:, 1] / words,
        np.log1p(100 * stats[:, 2] / words),
        np.log1p(100 * stats[:, 6] / chars),
        np.log1p(100 * stats[:, 5] / chars),
        np.log1p(100 * stats[:, 3] / words),
        np.log1p(100 * stats[:, 4] / words),
    ])


def expected_path(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows, the usual normaliser of such forests."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Trees as arrays; a leaf points to itself and holds its path length."""

    feature: np.ndarray
    split: np.ndarray
    low: np.ndarray
    high: np.ndarray
    path: np.ndarray
    depth: int
    norm: float
    threshold: float = math.inf

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Near 1: short paths, odd. Near 0.5 and below: ordinary."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                goes_low = x[rows, self.feature[t][at]] < self.split[t][at]
                at = np.where(goes_low, self.low[t][at], self.high[t][at])
            total += self.path[t][at]
        return 2.0 ** (-total / len(self.feature) / max(self.norm, 1e-9)) if len(self.feature) else total

    def odd(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x) > self.threshold


#: Columns of ``features`` that a forest sees: what texts are made of, and what they repeat. Repetition varies widely
#: among good texts; in one forest with the others it would take a share of all splits and hide what is odd in them.
KINDS = ((0, 1, 2, 3), (4, 5))


@dataclass(frozen=True)
class Forests:
    """A forest for each of KINDS, each with its own threshold; a text is odd if one of them says so."""

    parts: tuple[Forest, ...]

    def odd(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=bool)
        for columns, forest in zip(KINDS, self.parts):
            out |= forest.odd(x[:, columns])
        return out


def grow(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    """Each tree splits its own ``rows`` rows of ``x`` at random values of random features."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    depth, size = max(1, math.ceil(math.log2(max(2, rows)))), 2 * max(1, rows)
    shape = (trees if rows >= 2 else 0, size)
    forest = Forest(
        np.zeros(shape, np.int64), np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape, np.int64),
        np.zeros(shape), depth, expected_path(rows),
    )
    for t in range(shape[0]):
        todo, used = [(0, rng.choice(len(x), rows, replace=False), 0)], 1
        while todo:
            node, members, level = todo.pop()
            low, high = x[members].min(0), x[members].max(0)
            usable = np.flatnonzero(high > low)
            forest.low[t, node] = forest.high[t, node] = node
            if level == depth or len(usable) == 0:
                forest.path[t, node] = level + expected_path(len(members))
                continue
            f = rng.choice(usable)
            cut = rng.uniform(low[f], high[f])
            is_low = x[members, f] < cut
            if not is_low.any() or is_low.all():
                cut = high[f]
                is_low = x[members, f] < cut
            forest.feature[t, node], forest.split[t, node] = f, cut
            forest.low[t, node], forest.high[t, node] = used, used + 1
            todo += [(used, members[is_low], level + 1), (used + 1, members[~is_low], level + 1)]
            used += 2
    return forest


def calibrated(forest: Forest, counts: np.ndarray, max_clean_loss: float = MAX_CLEAN_LOSS) -> Forest:
    """Put the threshold where most bad rows lie above it and at most a share of the good ones do.

    ``counts`` has a row (score, good rows, bad rows) for each score, scores ascending. The threshold lies halfway
    to the next score. Without bad rows, or when no threshold gains more of them than of the good ones, nothing is odd.
    """
    best = math.inf
    cuts, clean, bad = counts.T
    if clean.sum() and bad.sum():
        lost, caught = 1 - np.cumsum(clean) / clean.sum(), 1 - np.cumsum(bad) / bad.sum()
        gain = np.where(lost <= max_clean_loss, caught - lost, -1)
        at = int(gain.argmax())
        if gain[at] > 0:
            best = float(cuts[at : at + 2].mean())
    return Forest(**{**forest.__dict__, "threshold": best})


def _score_counts(labelled: DataFrame, forest: Forest, kind: int, earlier: Forests) -> np.ndarray:
    """(score, good rows, bad rows) of the rows (STATISTICS, good) that no earlier forest finds odd, scores rounded to
    SCORE_DIGITS, ascending."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for rows in batches:
            x = features(rows[STATISTICS].to_numpy(dtype=float))
            scores = forest.scores(x[:, KINDS[kind]]).round(SCORE_DIGITS)
            yield pd.Series(np.where(earlier.odd(x), np.nan, scores))

    good = F.col("good") > 0
    scored = labelled.select(score(F.struct(*STATISTICS)).alias("score"), good.alias("is_good"))
    counts = scored.filter("score is not null and not isnan(score)").groupBy("score").agg(
        F.count_if("is_good").alias("n_good"), F.count_if(~F.col("is_good")).alias("n_bad")
    )
    return counts.orderBy("score").toPandas().to_numpy(dtype=float).reshape(-1, 3)


def _sample(df: DataFrame, columns: list[str], rows: int) -> np.ndarray:
    return bounded_sample(df.select("doc_id", *columns), rows).select(*columns).toPandas().to_numpy(dtype=float)


def train(stats: DataFrame, labels: DataFrame) -> Forests:
    """Fit on ``stats`` (doc_id and STATISTICS), calibrate on the rows that ``labels`` (doc_id, quality) covers.

    The first forest may lose MAX_CLEAN_LOSS of the good rows, the next what the ones before left of it. What reaches
    the driver is bounded: SAMPLE_ROWS rows for the trees, and a count for each rounded score of all labelled rows,
    both of texts that pass the base rules. Labels of null id or quality are ignored; a document with several labels
    counts once with the lowest.
    """
    passed = stats.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    sample = features(_sample(passed, STATISTICS, SAMPLE_ROWS).reshape(-1, len(STATISTICS)))
    known = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("double").alias("good"))
    )
    labelled = stage(passed.join(known, "doc_id").select("doc_id", *STATISTICS, "good").distinct())
    forests, left = Forests(()), MAX_CLEAN_LOSS
    for kind, columns in enumerate(KINDS):
        forest = grow(sample[:, columns])
        counts = _score_counts(labelled, forest, kind, forests)
        forest = calibrated(forest, counts, left)
        if len(counts) and counts[:, 1].sum():
            left -= counts[counts[:, 0] > forest.threshold, 1].sum() / counts[:, 1].sum()
        forests = Forests((*forests.parts, forest))
    return forests


def kept(forest: Forests, stats: np.ndarray) -> np.ndarray:
    """The text of these statistics passes the base rules and is not odd."""
    failed = (stats[:, 0] < MIN_WORDS) | (stats[:, 4] * 100 > stats[:, 0] * MAX_REPEAT_PERCENT)
    return ~failed & ~forest.odd(features(stats))


def _staged_statistics(docs: DataFrame) -> DataFrame:
    stats = docs.select(F.col("doc_id").cast("long").alias("doc_id"), rule_statistics().alias("s"))
    return stage(stats.select("doc_id", "s.*"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, STATISTICS, base_failed, kept) for every row of ``docs``.

    A null or empty text has no words and fails the base rules; a very long one is counted whole. Repeated rows are
    judged alike, an empty table gives an empty result; without usable labels only the base rules reject. Other
    columns, whatever their names, are left out.
    """
    stats = _staged_statistics(docs)
    forest = train(stats, labels)

    @F.pandas_udf("boolean")
    def verdict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(kept(forest, rows[STATISTICS].to_numpy(dtype=float)), dtype=bool)

    return stats.select(
        "doc_id", *STATISTICS,
        base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"),
        verdict(F.struct(*STATISTICS)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that ``judge`` keeps.

    The statistics are computed once to train and once more where the rows are filtered: two scans move nothing.
    Staging the texts beside their statistics spares a third of the Python time, but took 0.3 GB more of an executor
    and once more the input's size on disk. A null, empty or very long text is judged as any other, whole; repeated
    rows share their fate; column names may be those used here; an empty table stays empty.
    """
    forest = train(_staged_statistics(docs), labels)

    @F.pandas_udf("boolean")
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            stats = np.array([statistics_of(t) for t in texts], dtype=float).reshape(-1, len(STATISTICS))
            yield pd.Series(kept(forest, stats), dtype=bool)

    return unwrapped(wrapped(docs, t=text_bytes()).filter(verdict("t")))
