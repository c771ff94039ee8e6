"""Quality: a sparse ensemble of rules over text statistics.

Shallow trees grown on a bounded labelled sample give conjunctive rules ("share of
symbols > a and repeated words <= b"), one per path from the root. A lasso logistic
regression over the rules keeps the few that matter, and ``score_expression`` compiles
them into one Spark column over the statistics.

Defined results: a null text counts as an empty one, whose statistics are all zero, so
it has a score like any other; repeated rows score alike; a null id is never trained on;
with no usable label every text scores 0.5. Other columns of the input are kept by
``with_quality``, unless one has the score's own name, which is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shelfmark.llm.common import free_names, labelled_sample, ship_package
from shelfmark.llm.linear import fit_logistic

#: Labelled texts the model is fitted on at most.
MAX_TRAINING = 10_000
TREES = 40
#: Rows of each class that a tree is grown on at most, drawn anew for every tree.
TREE_DRAWS = 2000
DEPTH = 3
#: Training texts a leaf holds at least.
MIN_LEAF = 8
THRESHOLDS = 32
LASSO = 6e-4

STATISTICS = (
    "words",
    "chars_per_word",
    "longest_word",
    "symbol_share",
    "digit_share",
    "upper_share",
    "letter_share",
    "bare_symbol_words",
    "exclaimed_words",
    "sentence_words",
    "distinct_words",
    "same_as_before",
    "top_word_share",
    "lines_per_word",
    "distinct_lines",
    "distinct_pairs",
)
_SCHEMA = StructType([StructField(name, DoubleType()) for name in STATISTICS])
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()-]")


def text_statistics(text: str | None) -> tuple[float, ...]:
    """The statistics of one whole text, in the order of STATISTICS."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    chars = sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    upper = digits = letters = bare = exclaimed = ends = 0
    longest = 0
    for word, times in counts.items():
        longest = max(longest, len(word))
        if word.isalpha():
            letters += times * len(word)
            if not word.islower():
                upper += times * sum(c.isupper() for c in word)
            continue
        alpha = sum(c.isalpha() for c in word)
        letters += times * alpha
        digits += times * sum(c.isdigit() for c in word)
        upper += times * sum(c.isupper() for c in word)
        bare += times * (not alpha)
        exclaimed += times * (word[-1] in "!?")
        ends += times * (word[-1] in ".!?")
    symbols = sum(times * len(_SYMBOL.findall(word)) for word, times in counts.items() if not word.isalnum())
    pairs = set(zip(words, words[1:]))
    return (
        float(n),
        chars / n,
        float(longest),
        symbols / chars,
        digits / chars,
        upper / max(letters, 1),
        letters / chars,
        bare / n,
        exclaimed / n,
        ends / n,
        len(counts) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        max(counts.values()) / n,
        min(len(lines) / n, 1.0),
        len(set(lines)) / max(len(lines), 1),
        len(pairs) / max(n - 1, 1),
    )


@F.pandas_udf(_SCHEMA)
def statistics_of(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_statistics(t) for t in texts], columns=list(STATISTICS), dtype=float)


#: One condition: (statistic, True for ">", threshold). A rule is a tuple of them.
Condition = tuple[int, bool, float]
Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleEnsemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float


def _best_split(x: np.ndarray, y: np.ndarray, columns: np.ndarray) -> tuple[int, float] | None:
    """Column and threshold with the largest drop in squared error, or None."""
    best, choice = 1e-9, None
    n, total = len(y), y.sum()
    for c in columns:
        values = x[:, c]
        for threshold in np.unique(np.quantile(values, np.linspace(0, 1, THRESHOLDS + 2)[1:-1], method="lower")):
            right = values > threshold
            k = int(right.sum())
            if min(k, n - k) < MIN_LEAF:
                continue
            s = y[right].sum()
            gain = s * s / k + (total - s) ** 2 / (n - k) - total * total / n
            if gain > best:
                best, choice = gain, (int(c), float(threshold))
    return choice


def _grow(x: np.ndarray, y: np.ndarray, path: Rule, depth: int, draw: np.random.Generator, rules: dict[Rule, None]) -> None:
    if path:
        rules[tuple(sorted(path))] = None
    if depth == DEPTH or len(y) < 2 * MIN_LEAF or y.min() == y.max():
        return
    columns = np.sort(draw.choice(x.shape[1], size=max(2, x.shape[1] // 2), replace=False))
    split = _best_split(x, y, columns)
    if split is None:
        return
    c, threshold = split
    right = x[:, c] > threshold
    for above in (False, True):
        side = right == above
        _grow(x[side], y[side], (*path, (c, above, threshold)), depth + 1, draw, rules)


def rule_values(x: np.ndarray, rules: tuple[Rule, ...]) -> np.ndarray:
    out = np.empty((len(x), len(rules)), dtype=np.float32)
    for i, rule in enumerate(rules):
        holds = np.ones(len(x), dtype=bool)
        for c, above, threshold in rule:
            holds &= (x[:, c] > threshold) == above
        out[:, i] = holds
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> RuleEnsemble:
    """Grow trees on class-balanced bootstrap samples, then keep rules by the lasso."""
    draw = np.random.default_rng(seed)
    grown: dict[Rule, None] = {}
    classes = [np.flatnonzero(y == k) for k in (0.0, 1.0)]
    if all(len(c) for c in classes):
        for _ in range(TREES):
            size = min(TREE_DRAWS, max(len(c) for c in classes))
            rows = np.concatenate([draw.choice(c, size=size) for c in classes])
            _grow(x[rows], y[rows], (), 0, draw, grown)
    # rules that tell some training texts from others
    shares = [float(rule_values(x, (r,)).mean()) if len(x) else 0.0 for r in grown]
    rules = tuple(r for r, share in zip(grown, shares) if 0.0 < share < 1.0)
    values = rule_values(x, rules)
    largest = float(np.linalg.eigvalsh(values.T @ values / max(len(y), 1))[-1]) + 1.0 if len(rules) else 1.0
    weights, intercept = fit_logistic(
        lambda w: values @ w.astype(np.float32), lambda r: (r.astype(np.float32) @ values).astype(float), y, len(rules), largest, l1=LASSO, rounds=600
    )
    kept = np.flatnonzero(weights)
    return RuleEnsemble(tuple(rules[i] for i in kept), tuple(float(weights[i]) for i in kept), intercept if len(y) else 0.0)


def fit_quality(docs: DataFrame, labels: DataFrame, training: Column, max_training: int = MAX_TRAINING) -> RuleEnsemble:
    """Fit on ``labels.quality`` of the rows that ``training`` (over labels) selects.

    Statistics are computed on Spark; the driver gets them for ``max_training`` labelled
    texts at most.
    """
    ship_package(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", training, max_training)
    rows = sample.select("doc_id", "y", statistics_of("text").alias("s")).select("doc_id", "y", "s.*").toPandas()
    rows = rows.sort_values(["doc_id", *STATISTICS]).drop(columns="doc_id")
    return fit_rules(rows[list(STATISTICS)].to_numpy(dtype=float), rows["y"].to_numpy(dtype=float))


def score_expression(model: RuleEnsemble, statistics: str) -> Column:
    """The model as a column over the struct column ``statistics``."""
    z = F.lit(float(model.intercept))
    for rule, weight in zip(model.rules, model.weights):
        holds = F.lit(True)
        for c, above, threshold in rule:
            value = F.col(f"{statistics}.{STATISTICS[c]}")
            holds = holds & ((value > threshold) if above else (value <= threshold))
        z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def with_quality(docs: DataFrame, model: RuleEnsemble, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability that each whole text is of good quality."""
    ship_package(docs.sparkSession)
    (held,) = free_names(docs, "__statistics")
    scored = docs.withColumn(held, statistics_of(F.col(text).cast("string")))
    return scored.withColumn(score, score_expression(model, held)).drop(held)
