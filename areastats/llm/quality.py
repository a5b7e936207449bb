"""Quality: a sparse rule ensemble over text statistics.

Small boosted trees on a bounded labelled sample propose rules (paths of conditions), a logistic
regression with an l1 penalty weighs them, and what is left is one Spark column expression.
"""

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from areastats.llm.common import bounded_sample, fold, settled_labels

#: Labelled documents that training uses at most.
SAMPLE = 8000


def statistics(text: Column, words: Column) -> dict[str, Column]:
    """Statistics of a whole text; `words` is its array of words. Empty texts have zeros."""
    chars, count = F.greatest(F.length(text), F.lit(1)).cast("double"), F.greatest(F.size(words), F.lit(1)).cast("double")
    letters = lambda pattern: F.length(F.regexp_replace(text, pattern, "")) / chars
    again = F.zip_with(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), words, lambda a, b: a == b)
    return {
        "words": F.log1p(F.size(words).cast("double")),
        "word_length": F.length(text) / count,
        "distinct": F.size(F.array_distinct(words)) / count,
        "repeats": F.size(F.filter(again, lambda same: same)) / count,
        "upper": letters(r"\P{Lu}+"),
        "digits": letters("[^0-9]+"),
        "symbols": letters(r"[\p{L}\p{M}\p{N}\s.,;:'\"()?-]+"),
        "bars": letters("[^|]+"),
        "lines": F.regexp_count(text, F.lit("\n")) / count,
        "sentences": F.regexp_count(text, F.lit(r"[.!?]")) / count,
    }


STATISTICS = ("words", "word_length", "distinct", "repeats", "upper", "digits", "symbols", "bars", "lines", "sentences")
#: A condition (statistic, below, bound): below the bound, or at and above it.
Condition = tuple[int, bool, float]


class Rules:
    """Conjunctions of conditions with weights; fitted by trees and lasso."""

    def __init__(self) -> None:
        self.rules: list[tuple[Condition, ...]] = []
        self.weights = np.zeros(0)
        self.bias = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, penalty: float = 0.002) -> "Rules":
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        self.bias = float(np.log(share / (1 - share)))
        if len(y) == 0 or y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.01, 0.99, 50))) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), self.bias)
        found: dict[tuple[Condition, ...], None] = {}
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            self._grow(binned, cuts, y - p, p * (1 - p), np.arange(len(y)), (), depth, rate, score, found)
        self.rules = list(found)
        self._lasso(self.matrix(x), y, penalty)
        return self

    def _grow(self, x, cuts, grad, hess, rows, path, depth, rate, score, found) -> None:
        """Grow one tree; note the path to every node and add the leaf's step to the score."""
        if path:
            found[tuple(sorted(set(path)))] = None
        best = (1e-3, 0, 0)
        if depth and len(rows) >= 10:
            whole = grad[rows].sum() ** 2 / (hess[rows].sum() + 1)
            for f, c in enumerate(cuts):
                g = np.cumsum(np.bincount(x[rows, f], grad[rows], len(c) + 1))
                h = np.cumsum(np.bincount(x[rows, f], hess[rows], len(c) + 1))
                gain = g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1) - whole
                k = int(gain.argmax()) if len(gain) else 0
                if len(gain) and gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
        if best[0] == 1e-3:
            score[rows] += rate * grad[rows].sum() / (hess[rows].sum() + 1)
            return
        _, f, k = best
        low = x[rows, f] <= k
        bound = float(cuts[f][k])
        for below, part in ((True, rows[low]), (False, rows[~low])):
            self._grow(x, cuts, grad, hess, part, (*path, (f, below, bound)), depth - 1, rate, score, found)

    def matrix(self, x: np.ndarray) -> np.ndarray:
        """1 where a row meets a rule."""
        out = np.ones((len(x), len(self.rules)))
        for k, rule in enumerate(self.rules):
            for f, below, bound in rule:
                out[:, k] *= (x[:, f] < bound) == below
        return out

    def _lasso(self, m: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> None:
        """Accelerated proximal gradient for the mean logistic loss with an l1 penalty on the weights."""
        full = np.hstack([m, np.ones((len(m), 1))])
        rate = 4 * len(m) / (np.linalg.norm(full, 2) ** 2 + 1e-9)
        w = np.zeros(full.shape[1])
        w[-1] = self.bias
        v, t = w.copy(), 1.0
        for _ in range(steps):
            grad = full.T @ (1 / (1 + np.exp(-(full @ v))) - y) / len(y)
            new = v - rate * grad
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
            after = (1 + np.sqrt(1 + 4 * t * t)) / 2
            v, w, t = new + (t - 1) / after * (new - w), new, after
        keep = np.flatnonzero(w[:-1])
        self.rules, self.weights, self.bias = [self.rules[k] for k in keep], w[keep], float(w[-1])

    def column(self, named: dict[str, Column]) -> Column:
        """The score as a column expression."""
        def term(rule: tuple[Condition, ...], weight: float) -> Column:
            tests = [named[STATISTICS[f]] < bound if below else named[STATISTICS[f]] >= bound for f, below, bound in rule]
            return F.when(reduce(lambda a, b: a & b, tests), F.lit(float(weight))).otherwise(F.lit(0.0))

        total = sum((term(r, w) for r, w in zip(self.rules, self.weights, strict=True)), F.lit(self.bias))
        return 1 / (1 + F.exp(-total))


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, statistics) of every document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    split = rows.withColumn("word_list", F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    named = statistics(F.col("text"), F.col("word_list"))
    return split.select("doc_id", *[named[n].cast("double").alias(n) for n in STATISTICS])


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Rules:
    """Fit on up to about `sample` labelled documents outside the held-out fold, chosen by hash."""
    marked = settled_labels(labels, "quality")
    marked = bounded_sample(marked.where(fold(F.col("label_id"), 5) != 0), "label_id", sample)
    rows = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).alias("text")).dropna()
    chosen = rows.join(F.broadcast(marked), "label_id")  # at most `sample` short rows
    table = sorted(map(tuple, described(chosen, "label_id", "text").join(F.broadcast(marked.withColumnRenamed("label_id", "doc_id")), "doc_id").select(*STATISTICS, "label").collect()))
    data = np.array(table, float).reshape(len(table), len(STATISTICS) + 1)
    return Rules().fit(data[:, :-1], data[:, -1])


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from statistics of its whole text.

    Documents whose crc32(doc_id) mod 5 is 0 are held out of training. Null texts count as empty,
    and all empty texts score alike. Repeated rows give repeated results; without any usable label
    every score is the same constant.
    """
    rules = fitted(docs, labels, id_col, text_col, sample)
    rows = described(docs, id_col, text_col)
    score = rules.column({n: F.col(n) for n in STATISTICS})
    scored = rows.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
