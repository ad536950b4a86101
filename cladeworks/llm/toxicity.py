"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(cut_k - w.x) with one weight vector for all ordered cuts. Labels only say toxic
or not, so the labelled toxic documents are graded 1 to 3 by how dense the telling words are in them,
split at the terciles; documents that are not toxic have grade 0. A document is flagged if its chance of
a grade of 1 or more reaches the threshold, and its severity is the expected grade.

The fit uses the labelled rows with the smallest hash, ``SAMPLE_DOCS`` at most (a documented bound); the
features, telling words and all, come from that sample. Every document is scored on its whole text.

Defined results: null and empty texts have no words and get the severity of the cuts alone; repeated rows
get equal results; labels that contradict each other for an id count as toxic; without labelled rows of
both kinds nothing is flagged and every severity is 0; columns of the input pass through, new ones start
with ``_tx_``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.columns import apart
from cladeworks.runtime import materialize, read_table

SAMPLE_DOCS = 3_000
#: Words and word beginnings kept as features, the toxic sample documents that one must be in, the lengths of beginnings.
FEATURES, LEAST_DOCS, STEMS = 384, 4, range(4, 10)
GRADES = 4
THRESHOLD = 0.5
#: Words whose features a worker keeps at once.
HEARD_WORDS = 300_000
WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def features(word: str) -> list[str]:
    """A word and its beginnings; these end in an asterisk."""
    return [word, *(f"{word[:n]}*" for n in STEMS if n <= len(word))]


def encode(counts: Counter, total: int, vocabulary: dict[str, int], row: np.ndarray) -> None:
    """Two values a feature: the log of its count, and of its rate per hundred words."""
    n = len(vocabulary)
    for name, count in counts.items():
        at = vocabulary[name]
        row[at] = np.log1p(count)
        row[n + at] = np.log1p(count * 100 / (total + 20))


@dataclass(frozen=True)
class OrdinalModel:
    vocabulary: dict[str, int]
    weights: np.ndarray
    cuts: np.ndarray

    def exceed(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= 1), ..., P(grade >= 3) by row."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - (x @ self.weights)[:, None], -60, 60)))

    def matrix(self, texts: list[str | None], heard: dict[str, list[str]]) -> np.ndarray:
        """Rows of features; ``heard`` remembers which features a word has, and is bounded by its caller."""
        x = np.zeros((len(texts), max(1, 2 * len(self.vocabulary))))
        for row, text in enumerate(texts):
            found = words(text)
            counts: Counter = Counter()
            for word, n in Counter(found).items():
                names = heard.get(word)
                if names is None:
                    names = heard[word] = [f for f in features(word) if f in self.vocabulary] or NOTHING
                for name in names:
                    counts[name] += n
            encode(counts, len(found), self.vocabulary, x[row])
        return x


NOTHING: list[str] = []


def _telling(docs: list[Counter], toxic: np.ndarray) -> dict[str, float]:
    """Features with the largest chi-square among those more frequent in toxic documents; their log odds."""
    yes, no = Counter(), Counter()
    for counts, bad in zip(docs, toxic, strict=True):
        (yes if bad else no).update({f for w in counts for f in features(w)})
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    scored = []
    for name, a in yes.items():
        if a >= LEAST_DOCS and a / n1 > (b := no[name]) / n0:
            share = (a + b) / (n1 + n0)
            scored.append(((a / n1 - b / n0) ** 2 / max(share * (1 - share), 1e-9), name, float(np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1)))))
    scored.sort(key=lambda x: (-x[0], x[1]))
    return {name: odds for _, name, odds in scored[:FEATURES]}


def fit_ordinal(x: np.ndarray, grades: np.ndarray, ridge: float = 3e-4, steps: int = 500, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered cuts by Adam on the mean negative log likelihood."""
    levels = GRADES - 1
    # Parameters: weights, first cut, logs of the gaps between cuts.
    p = np.concatenate([np.zeros(x.shape[1]), [1.0], np.zeros(levels - 1)])
    m, v, rows = np.zeros_like(p), np.zeros_like(p), np.arange(len(x))
    for t in range(1, steps + 1):
        w, gaps = p[: -levels], np.exp(p[-levels + 1 :])
        cuts = p[-levels] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = cuts[None, :] - (x @ w)[:, None]
        cdf = np.pad(1 / (1 + np.exp(-np.clip(z, -60, 60))), ((0, 0), (1, 1)), constant_values=((0, 0), (0, 1)))
        cdf[:, 0] = 0.0
        density = cdf * (1 - cdf)
        chance = np.maximum(cdf[rows, grades + 1] - cdf[rows, grades], 1e-12)
        upper, lower = density[rows, grades + 1] / chance, density[rows, grades] / chance
        slope_w = x.T @ (upper - lower) / len(x) + ridge * w
        by_cut = np.zeros(levels + 2)
        np.add.at(by_cut, grades + 1, -upper)
        np.add.at(by_cut, grades, lower)
        by_cut = by_cut[1:-1] / len(x)
        tail = np.cumsum(by_cut[::-1])[::-1]
        slope = np.concatenate([slope_w, [tail[0]], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return p[:-levels], p[-levels] + np.concatenate([[0.0], np.cumsum(np.exp(p[-levels + 1 :]))])


def train(texts: list[Counter], toxic: np.ndarray) -> OrdinalModel:
    """From word counts and labels of the sample."""
    if not toxic.any() or toxic.all():
        return OrdinalModel({}, np.zeros(1), np.full(GRADES - 1, 60.0))
    odds = _telling(texts, toxic)
    vocabulary = {w: i for i, w in enumerate(sorted(odds))}
    x = np.zeros((len(texts), max(1, 2 * len(vocabulary))))
    density = np.zeros(len(texts))
    for row, counts in enumerate(texts):
        total, named = sum(counts.values()), Counter()
        for word, n in counts.items():
            for name in features(word):
                if name in vocabulary:
                    named[name] += n
        encode(named, total, vocabulary, x[row])
        density[row] = sum(n * odds[name] for name, n in named.items()) / max(1, total)
    bounds = np.quantile(density[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + np.searchsorted(bounds, density, side="right"), 0)
    return OrdinalModel(vocabulary, *fit_ordinal(x, grades))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            counts = [Counter(words(text.as_py())) for text in part.column(0)]
            lists = [pa.array([list(c) for c in counts], pa.list_(pa.string())), pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*lists, *part.columns[1:]], ["words", "counts", "toxic", "by_id", "by_text"])


def sample_ids(labels: DataFrame, rows: int = SAMPLE_DOCS) -> DataFrame:
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_tx_label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    chosen = materialize(sample_ids(labels)).withColumnRenamed("doc_id", "_tx_id")
    rows = docs.select(F.col(id_col).alias("_tx_id"), F.col(text_col).alias("_tx_text")).join(F.broadcast(chosen), "_tx_id")
    rows = rows.select("_tx_text", "_tx_label", F.xxhash64("_tx_id"), F.xxhash64("_tx_text"))
    counts = rows.mapInArrow(_word_counts, "words array<string>, counts array<long>, toxic int, by_id long, by_text long")
    # Repeats of an id can bring more rows than ids; the bound holds for rows too, in an order that reruns keep.
    table = counts.orderBy("by_id", "by_text", "toxic").limit(SAMPLE_DOCS).toArrow()
    docs_words = [Counter(dict(zip(w, n, strict=True))) for w, n in zip(table["words"].to_pylist(), table["counts"].to_pylist(), strict=True)]
    return train(docs_words, np.array(table["toxic"].to_pylist(), dtype=bool))


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_tx_severity`` (expected grade), ``_tx_chance`` (of any toxicity) and ``_tx_grade`` (likeliest); columns of the prefix ``_tx_`` are replaced."""
    fields = [f for f in docs.schema.fields if not f.name.startswith("_tx_")]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heard: dict[str, list[str]] = {}
        for batch in batches:
            texts = batch.column(names.index(text_col))
            parts = []
            for at in range(0, batch.num_rows, 512):
                if len(heard) > HEARD_WORDS:
                    heard.clear()
                parts.append(model.exceed(model.matrix(texts.slice(at, 512).to_pylist(), heard)))
            over = np.concatenate(parts) if parts else np.zeros((0, GRADES - 1))
            if not model.vocabulary:
                over[:] = 0.0
            full = np.pad(over, ((0, 0), (1, 1)), constant_values=((0, 0), (1, 0)))
            full[:, -1] = 0.0
            likeliest = np.argmax(full[:, :-1] - full[:, 1:], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(over.sum(axis=1)), pa.array(over[:, 0]), pa.array(likeliest)], [*names, "_tx_severity", "_tx_chance", "_tx_grade"])

    schema = docs.select(*names).schema.add("_tx_severity", "double").add("_tx_chance", "double").add("_tx_grade", "integer")
    return docs.select(*names).mapInArrow(run, schema)


def reject_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without those that are flagged."""
    model = fit(docs, labels, text_col=text_col)
    return apart(docs, lambda rows, text_col: score(rows, model, text_col).where(F.col("_tx_chance") < THRESHOLD).select(*rows.columns), text_col=text_col)


def op9_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.round("_tx_severity", 6).alias("severity"), F.round("_tx_chance", 6).alias("p_toxic"), F.col("_tx_grade").alias("grade"), (F.col("_tx_chance") >= THRESHOLD).alias("toxic"))
