"""Quality of documents by a sparse ensemble of rules over text statistics.

Statistics of whole texts are Spark columns. Shallow trees, boosted on a bounded sample of labelled rows, split on
them; every path from a root to a node is a rule, a conjunction of bounds on statistics. A logistic model with an L1
penalty weighs the rules, most weights become zero, and the rest is compiled into one Spark column expression, so scoring is
a narrow projection without Python.

Labels are learned from rows whose crc32 of the id as text is not divisible by ``FOLDS``: the ``SAMPLE_DOCS`` ids with the smallest
hash at most (a documented bound). Ids, labels, language and source are never inputs of a score.

Defined results: null and empty texts have zero in every statistic and get the score that this gives; a text of any length is read
whole; equal texts get equal scores; a null id is never held out nor learned from; ids whose labels contradict each other are not
learned from; without labelled rows of both kinds every score is the share of good labels, smoothed by one of either kind; an empty
table gives no rows. Columns of the input pass through, new ones start with ``_qu_`` and replace such columns of the input.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.runtime import materialize, read_table

SAMPLE_DOCS = 6_000
FOLDS = 5
THRESHOLD = 0.3
#: Trees, their depth, the bounds tried a statistic, the least rows of a leaf, the step of boosting and the shares of rows and statistics that a tree sees.
TREES, DEPTH, BOUNDS, LEAST_ROWS, RATE, ROW_SHARE, STAT_SHARE = 60, 3, 32, 8, 0.3, 0.6, 0.6
#: L1 penalty on standardised rules and the steps of the solver.
PENALTY, STEPS = 1e-3, 800
SEED = 13

#: Characters counted a hundred characters, by statistic.
CHARACTERS = {
    "upper": r"\p{Lu}",
    "digits": r"[0-9]",
    "symbols": r"[#$%&*|]",
    "emphasis": r"[!?]",
    "marks": r"[\p{P}\p{S}]",
    "foreign": r"[^\x00-\x7F]",
}
#: Matches counted a hundred words.
PATTERNS = {
    "bare": r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])",
    "long": r"[^\x20\x09-\x0D]{16,}+",
    "stops": r"[.!?](?:[\x20\x09-\x0D]|$)",
}
STATISTICS = ["words", "chars_word", "distinct", "repeats", "same_lines", "line_words", *CHARACTERS, *PATTERNS]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``_qu_<statistic>`` for each of ``STATISTICS``."""
    kept = docs.select(*(c for c in docs.columns if not c.startswith("_qu_")))
    staged = kept.withColumn("_qu_text", F.coalesce(F.col(text_col), F.lit("")))
    text = F.col("_qu_text")
    staged = staged.withColumn("_qu_split", F.array_remove(F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " "), ""))
    staged = staged.withColumn("_qu_lines", F.array_remove(F.split(text, "\n"), ""))
    split, lines = F.col("_qu_split"), F.col("_qu_lines")
    staged = staged.withColumns({"_qu_n": F.size(split), "_qu_chars": F.length(text)})
    per_word, per_char = F.greatest("_qu_n", F.lit(1)).cast("double"), F.greatest("_qu_chars", F.lit(1)).cast("double")
    again = F.zip_with(split, F.slice(split, 2, F.greatest("_qu_n", F.lit(1))), lambda x, y: (x == y).cast("int"))
    values = {
        "words": F.col("_qu_n").cast("double"),
        "chars_word": F.length(F.array_join(split, "")) / per_word,
        "distinct": 100.0 * F.size(F.array_distinct(split)) / per_word,
        "repeats": 100.0 * F.aggregate(again, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) / per_word,
        "same_lines": 100.0 * (F.size(lines) - F.size(F.array_distinct(lines))) / F.greatest(F.size(lines), F.lit(1)),
        "line_words": F.col("_qu_n") / F.greatest(F.size(lines), F.lit(1)),
    }
    values |= {name: 100.0 * F.regexp_count(text, F.lit(p)) / per_char for name, p in CHARACTERS.items()}
    values |= {name: 100.0 * F.regexp_count(text, F.lit(p)) / per_word for name, p in PATTERNS.items()}
    return staged.select(*kept.columns, *(values[s].cast("double").alias(f"_qu_{s}") for s in STATISTICS))


#: A bound on a statistic: its number, whether it has to be above, and the bound.
Bound = tuple[int, bool, float]


@dataclass(frozen=True)
class RuleModel:
    rules: list[tuple[Bound, ...]]
    weights: np.ndarray
    intercept: float

    def matches(self, x: np.ndarray) -> np.ndarray:
        """Which rows of statistics meet which rule."""
        columns = [reduce(np.logical_and, ((x[:, s] > b) if above else (x[:, s] <= b) for s, above, b in rule)) for rule in self.rules]
        return np.array(columns, dtype=float).reshape(len(self.rules), len(x)).T

    def score(self) -> Column:
        """The chance of a good label, over the columns of ``with_statistics``."""
        logit = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            parts = [(F.col(f"_qu_{STATISTICS[s]}") > b) if above else (F.col(f"_qu_{STATISTICS[s]}") <= b) for s, above, b in rule]
            logit = logit + F.when(reduce(Column.__and__, parts), F.lit(float(weight))).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-logit))


def _tree(codes: np.ndarray, bounds: list[np.ndarray], slope: np.ndarray, rows: np.ndarray, stats: np.ndarray, depth: int, path: tuple[Bound, ...], out: list[tuple[Bound, ...]], leaves: dict[tuple[Bound, ...], float]) -> None:
    """Grow a regression tree on ``slope`` over binned statistics; its paths go to ``out``, the means of its leaves to ``leaves``."""
    best = None
    total, n = slope[rows].sum(), len(rows)
    if depth:
        for s in stats:
            size = len(bounds[s])
            if not size:
                continue
            count = np.bincount(codes[rows, s], minlength=size + 1)[:size].cumsum()
            left = np.bincount(codes[rows, s], weights=slope[rows], minlength=size + 1)[:size].cumsum()
            fits = (count >= LEAST_ROWS) & (n - count >= LEAST_ROWS)
            gain = np.where(fits, left**2 / np.maximum(count, 1) + (total - left) ** 2 / np.maximum(n - count, 1) - total**2 / n, 0.0)
            at = int(np.argmax(gain))
            if gain[at] > 1e-9 and (best is None or gain[at] > best[0]):
                best = gain[at], s, at
    if best is None:
        leaves[path] = total / max(n, 1)
        return
    _, s, at = best
    goes = codes[rows, s] <= at
    for above, part in ((False, rows[goes]), (True, rows[~goes])):
        longer = (*path, (int(s), above, float(bounds[s][at])))
        out.append(longer)
        _tree(codes, bounds, slope, part, stats, depth - 1, longer, out, leaves)


def _holds(x: np.ndarray, rule: tuple[Bound, ...]) -> np.ndarray:
    return reduce(np.logical_and, ((x[:, s] > b) if above else (x[:, s] <= b) for s, above, b in rule), np.ones(len(x), dtype=bool))


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[tuple[Bound, ...]]:
    """Paths of trees that are boosted on the logistic loss; rules that hold for the same rows are one."""
    rng = np.random.default_rng(SEED)
    # Bounds lie midway between neighbouring quantiles, so rows near a quantile do not sit on a bound.
    points = [np.unique(np.quantile(x[:, s], np.linspace(0, 1, BOUNDS + 1), method="nearest")) for s in range(x.shape[1])]
    bounds = [(p[1:] + p[:-1]) / 2 for p in points]
    codes = np.stack([np.searchsorted(b, x[:, s], side="left") for s, b in enumerate(bounds)], axis=1)
    margin = np.full(len(y), np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    found: list[tuple[Bound, ...]] = []
    for _ in range(TREES):
        slope = y - 1 / (1 + np.exp(-margin))
        rows = np.sort(rng.choice(len(y), max(1, int(ROW_SHARE * len(y))), replace=False))
        stats = np.sort(rng.choice(x.shape[1], max(1, int(STAT_SHARE * x.shape[1])), replace=False))
        leaves: dict[tuple[Bound, ...], float] = {}
        _tree(codes, bounds, slope, rows, stats, DEPTH, (), found, leaves)
        for path, value in leaves.items():  # a tree is grown on some rows, and all rows take its step
            margin[_holds(x, path)] += RATE * 4 * value
    seen: dict[bytes, tuple[Bound, ...]] = {}
    for rule in found:
        seen.setdefault(np.packbits(_holds(x, rule)).tobytes(), rule)
    return list(seen.values())


def fit_lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the mean logistic loss plus ``penalty`` times the absolute weights of standardised columns; accelerated proximal gradient."""
    mean, scale = z.mean(axis=0), np.maximum(z.std(axis=0), 1e-9)
    design = np.column_stack([(z - mean) / scale, np.ones(len(z))])
    size = 4 * len(z) / max(np.linalg.norm(design, 2) ** 2, 1e-9)
    bar = np.append(np.full(z.shape[1], size * penalty), 0.0)
    w = ahead = np.append(np.zeros(z.shape[1]), np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    t = 1.0
    for _ in range(steps):
        slope = design.T @ (1 / (1 + np.exp(-np.clip(design @ ahead, -60, 60))) - y) / len(y)
        moved = ahead - size * slope
        new = np.sign(moved) * np.maximum(np.abs(moved) - bar, 0.0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (last - 1) / t * (new - w), new
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def train(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """From statistics and labels of the sample."""
    if len(y) == 0 or y.min() == y.max():
        return RuleModel([], np.zeros(0), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    rules = tree_rules(x, y)
    z = RuleModel(rules, np.zeros(len(rules)), 0.0).matches(x)
    weights, intercept = fit_lasso(z, y)
    kept = np.flatnonzero(weights)
    return RuleModel([rules[k] for k in kept], weights[kept], intercept)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def sample_ids(labels: DataFrame, rows: int = SAMPLE_DOCS) -> DataFrame:
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    known = known.where("low = high").select(F.col("doc_id").alias("_qu_id"), (F.col("low") == 1).cast("double").alias("_qu_label"))
    return known.orderBy(F.xxhash64("_qu_id"), "_qu_id").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> RuleModel:
    chosen = materialize(sample_ids(labels))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), F.col("_id") == F.col("_qu_id"))
    # The statistics replace columns of their prefix, so the label goes under another name.
    rows = with_statistics(rows.select("_id", "_text", F.col("_qu_label").alias("_label")), "_text")
    # Repeats of an id can bring more rows than ids; the bound holds for rows too, in an order that reruns keep.
    found = rows.orderBy(F.xxhash64("_id"), F.xxhash64("_text")).select("_label", *(f"_qu_{s}" for s in STATISTICS)).limit(SAMPLE_DOCS).toArrow()
    values = np.column_stack([c.to_numpy() for c in found.columns])
    return train(values[:, 1:], values[:, 0])


def score(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """``docs`` with its statistics and ``_qu_score``."""
    return with_statistics(docs, text_col).withColumn("_qu_score", model.score())


def op13_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("_qu_score").alias("score"), (F.col("_qu_score") >= THRESHOLD).cast("int").alias("predicted"))
