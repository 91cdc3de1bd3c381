"""Quality classifier: a sparse ensemble of rules.

Shallow boosted trees are grown on statistics of the text.  Every path of a
tree is a conjunctive rule; a lasso logistic regression over all rules keeps a
few of them, and the kept rules are compiled to one Spark column expression.
Statistics are taken from every text; the fit sees a bounded sample.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import staged, with_text

MOST_SAMPLED = 20_000  # labelled rows the fit sees, those of the smallest hashes
TREES, DEPTH, BINS, RATE = 40, 3, 24, 0.3
FOLDS = 5

_SETS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
         "symbol": b"#*$%&|<>", "mark": b"!?", "stop": b".,;:", "quote": b"'\"()[]{}/\\-_@="}
FEATURES = (*[f"{k}_share" for k in _SETS], "space_share", "high_share", "words", "word_length", "longest_word",
            "distinct_share", "top_share", "line_words", "same_line_share", "same_pair_share")


def statistics(text: bytes) -> tuple[float, ...]:
    """The features of one text; all zero for an empty one."""
    size = max(len(text), 1)
    shares = [(len(text) - len(text.translate(None, s))) / size for s in _SETS.values()]
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    space = (len(text) - sum(map(len, words))) / size
    if not words:
        return (*shares, space, *[0.0] * (len(FEATURES) - len(shares) - 1))
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    return (*shares, space, (len(text) - len(text.decode("utf-8", "replace"))) / size, float(len(words)),
            sum(map(len, words)) / len(words), float(max(map(len, words))), len(counts) / len(words),
            counts.most_common(1)[0][1] / len(words), len(words) / len(lines),
            1 - len(set(lines)) / len(lines), 1 - pairs / max(len(words) - 1, 1) if pairs else 0.0)


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and the features of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(x.as_buffer().to_pybytes()) for x in batch.column(1)]
            values = np.array(rows, np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(values[:, i].copy()) for i in range(len(FEATURES))]], ["doc_id", *FEATURES])

    return with_text(docs, encoded=True).mapInArrow(run, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


#: A rule is a set of conditions (feature number, at most this value or else above it, value).
Rule = frozenset


@dataclass
class Ensemble:
    bias: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        """The probability of label 1, from the feature columns."""
        def met(rule: Rule) -> Column:
            tests = [F.col(FEATURES[f]) <= v if low else F.col(FEATURES[f]) > v for f, low, v in sorted(rule)]
            return reduce(Column.__and__, tests)

        margin = reduce(Column.__add__, [F.when(met(r), w).otherwise(0.0) for r, w in self.rules], F.lit(self.bias))
        return 1 / (1 + F.exp(-margin))


def _tree(codes: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray,
          rows: np.ndarray, path: tuple, depth: int, rules: set, out: np.ndarray) -> None:
    """Grows a tree below ``path``, notes its paths as rules and writes leaf values to ``out``."""
    if path:
        rules.add(Rule(path))
    best, choice = 1e-3, None
    total_g, total_w = gradient[rows].sum(), weight[rows].sum() + 1.0
    if depth and len(rows) >= 20:
        for f, edge in enumerate(edges):
            if not len(edge):
                continue
            g = np.bincount(codes[rows, f], gradient[rows], len(edge) + 1).cumsum()[:-1]
            w = np.bincount(codes[rows, f], weight[rows], len(edge) + 1).cumsum()[:-1]
            n = np.bincount(codes[rows, f], minlength=len(edge) + 1).cumsum()[:-1]
            gain = g**2 / (w + 1) + (total_g - g) ** 2 / (total_w - w) - total_g**2 / total_w
            gain[(n < 8) | (n > len(rows) - 8)] = -1
            k = int(gain.argmax())
            if gain[k] > best:
                best, choice = gain[k], (f, k)
    if choice is None:
        out[rows] = total_g / total_w
        return
    f, k = choice
    low = codes[rows, f] <= k
    for part, side in ((rows[low], True), (rows[~low], False)):
        _tree(codes, edges, gradient, weight, part, (*path, (f, side, float(edges[f][k]))), depth - 1, rules, out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _unlike(matrix: np.ndarray) -> list[int]:
    """The first of each set of columns that are equal in all rows."""
    first: dict[bytes, int] = {}
    for i, column in enumerate(np.packbits(matrix.astype(bool), axis=0).T):
        first.setdefault(column.tobytes(), i)
    return list(first.values())


def fit(values: np.ndarray, labels: np.ndarray, penalty: float = 2e-4, steps: int = 400) -> Ensemble:
    """Trees by boosting, their paths as rules, rule weights by lasso logistic regression."""
    rate = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    prior = float(np.log(rate / (1 - rate)))
    if len(np.unique(labels)) < 2:
        return Ensemble(prior, [])
    edges = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(values.shape[1])]
    codes = np.stack([np.searchsorted(e, values[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    margin, found = np.full(len(labels), prior), set()
    for _ in range(TREES):
        p, out = _sigmoid(margin), np.zeros(len(labels))
        _tree(codes, edges, labels - p, p * (1 - p), np.arange(len(labels)), (), DEPTH, found, out)
        margin += RATE * out
    if not found:
        return Ensemble(prior, [])
    rules = sorted(found, key=lambda r: (len(r), sorted(r)))
    matrix = np.stack([np.logical_and.reduce([
        (values[:, f] <= v) == low for f, low, v in r]) for r in rules], axis=1).astype(np.float32)
    unlike = _unlike(matrix)
    rules, matrix = [rules[i] for i in unlike], matrix[:, unlike]
    mean = matrix.mean(axis=0)
    spread = np.maximum(matrix.std(axis=0), 0.05)
    scaled = (matrix - mean) / spread
    bound = 0.25 * (np.linalg.norm(scaled, 2) ** 2 / len(labels) + 1)
    weights, bias = np.zeros(len(rules), np.float32), prior
    ahead, ahead_bias, pace = weights, bias, 1.0
    for _ in range(steps):  # accelerated proximal gradient
        error = _sigmoid(scaled @ ahead + ahead_bias) - labels
        moved = ahead - (scaled.T @ error.astype(np.float32)) / len(labels) / bound
        after = np.sign(moved) * np.maximum(np.abs(moved) - penalty / bound, 0)
        after_bias = ahead_bias - error.mean() / bound
        quicker = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = after + (pace - 1) / quicker * (after - weights)
        ahead_bias = after_bias + (pace - 1) / quicker * (after_bias - bias)
        weights, bias, pace = after, after_bias, quicker
    kept = np.flatnonzero(weights)
    return Ensemble(float(bias - (weights * mean / spread).sum()),
                    [(rules[i], float(weights[i] / spread[i])) for i in kept])


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def scored(docs: DataFrame, labels: DataFrame, most: int = MOST_SAMPLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Only labels of rows outside the held-out fold are learned from, at most
    ``most`` of them.  Null and empty texts have all-zero features and a score
    like any other.  Several labels of a document count as their smallest.
    Without labels every score is one half; with one kind only it is the same
    for all.  Rows without doc_id are scored, never learned from, and not held out.
    """
    table = staged(featured(docs), "features")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
             .where("label is not null and doc_id is not null").where(remainder(F.col("doc_id")) != 0)
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    sample = (table.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
              .select("label", *FEATURES).toArrow())
    rows = np.stack([sample.column(f).to_numpy() for f in FEATURES], axis=1)
    model = fit(rows, sample.column("label").to_numpy().astype(np.float64))
    score = model.score()
    return (table.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                         score.cast("double").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))
