"""Quality classifier: histogram gradient-boosted trees over statistics of the text.

Trees are complete and level-wise, so they flatten into arrays, and a batch walks all
trees at once in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm.common import add_columns, remainder, sampled, table, texts_of
from dealtide.llm.textstats import NAMES, statistics

# Labelled rows to fit on, at most; only their statistics come to the driver.
SAMPLE = 20_000
# The held-out rows and the threshold of the query.
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3


@dataclass
class Trees:
    """``feature`` and ``cut`` by tree and inner node (breadth first), ``leaf`` by tree and leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), self.base)
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        inner = self.feature.shape[1]
        while True:
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
            if node[0, 0] >= inner if len(x) else True:
                break
        return self.base + self.leaf[trees, node - inner].sum(1) if len(x) else np.zeros(0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -50, 50)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 32, rate: float = 0.15, ridge: float = 5.0) -> Trees:
    """Second-order boosting of the log loss on per-feature histograms of at most ``bins`` quantile bins."""
    inner, leaves = 2**depth - 1, 2**depth
    if not len(y):
        return Trees(0.0, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    feature, cut, leaf = np.zeros((trees, inner), int), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    score = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), int)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            best = np.zeros(width)
            at = np.full((width, 2), -1)
            for f, c in enumerate(cuts):
                key = node * bins + binned[:, f]
                gs = np.bincount(key, g, width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(key, h, width * bins).reshape(width, bins).cumsum(1)
                left, lh, g_all, h_all = gs[:, : len(c)], hs[:, : len(c)], gs[:, -1:], hs[:, -1:]
                gain = left**2 / (lh + ridge) + (g_all - left) ** 2 / (h_all - lh + ridge) - g_all**2 / (h_all + ridge)
                if not gain.shape[1]:
                    continue
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best + 1e-9
                best = np.where(better, gain[np.arange(width), top], best)
                at[better] = np.stack([np.full(width, f), top], 1)[better]
            for n, (f, b) in enumerate(at):
                if f >= 0:
                    feature[t, first + n], cut[t, first + n] = f, cuts[f][b]
            node = 2 * node + (x[np.arange(len(y)), feature[t, first + node]] > cut[t, first + node])
        leaf[t] = rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + ridge)
        score = score + leaf[t][node]
    return Trees(base, feature, cut, leaf)


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from at most about ``sample`` labelled rows outside of the held-out fold. No labels: all score 0.5."""
    known = labels.where("quality IS NOT NULL").where(remainder("doc_id", FOLDS) != HELD_OUT).select("doc_id", "quality")
    rows = documents.select("doc_id", "text").join(F.broadcast(sampled(known, "doc_id", sample)), "doc_id")
    read = add_columns(rows, "x array<double>", lambda b: [[statistics(t or b"") for t in texts_of(b)]], drop=("text",))
    got = sorted(((r.doc_id, r.quality, r.x) for r in read.collect()), key=lambda r: (r[0], r[1], r[2]))
    return fit_trees(np.array([r[2] for r in got]).reshape(-1, len(NAMES)), np.array([r[1] for r in got], float))


def score(documents: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with score and predicted, which replace input columns of these names.

    Only the text is read. Null and empty texts have all-zero statistics and get a score as any
    other. Equal texts get equal scores; empty tables stay empty.
    """

    def columns(batch: pa.RecordBatch) -> list:
        found = model.probability(np.array([statistics(t or b"") for t in texts_of(batch)]).reshape(-1, len(NAMES)))
        return [found, (found >= threshold).astype(np.int32)]

    return add_columns(documents, "score double, predicted int", columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    # a null id is in no fold
    held_out = F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return score(documents, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
