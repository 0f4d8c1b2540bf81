"""Quality scores from histogram gradient-boosted trees over document statistics.

One pass over the texts leaves a row of statistics for each document. Trees are grown on the
driver from a bounded sample of labelled rows (``sample_rows``, chosen by a hash of the id):
values are put into at most 64 bins, each level of a tree takes the split that most lowers the
logistic loss, read off gradient and hessian histograms. All trees have one shape, so that they
lie in arrays by (tree, node) and a batch of documents walks down them at once.

Null texts count as empty and are scored too. Rows of ``labels`` without a label, or of unknown
documents, are not used; several labels of one document are all used. Without labels of both
kinds every score is the share of ones, or 0.5. Repeated documents are scored each; a null
``doc_id`` stays null and is not held out. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.statistics import FEATURES, features
from clickloom.llm.storage import stored
from clickloom.llm.text import map_texts

SAMPLE_ROWS = 20_000


@dataclass
class Trees:
    """Complete trees of one depth: inner nodes by (tree, node), leaves by (tree, leaf)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Boost ``trees`` trees of ``depth`` levels on rows ``x`` with labels ``y`` of 0 and 1."""
    inner, leaves = 2**depth - 1, 2**depth
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    model = Trees(float(np.log(share / (1 - share))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not len(y) or y.min() == y.max():
        return model
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])  # bin <= b: x <= edge b
    usable = np.arange(bins)[None, :] < np.array([len(e) for e in edges])[:, None]
    flat = binned + np.arange(width) * bins
    raw = np.full(n, model.base)
    found = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            count, low = 2**level, 2**level - 1
            at = ((node - low)[:, None] * (width * bins) + flat).ravel()
            size = count * width * bins
            g = np.bincount(at, np.repeat(gradient, width), size).reshape(count, width, bins).cumsum(2)
            h = np.bincount(at, np.repeat(hessian, width), size).reshape(count, width, bins).cumsum(2)
            whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge) - whole_g**2 / (whole_h + ridge)
            gain[~(usable[None] & (h >= least) & (whole_h - h >= least))] = 0
            best = gain.reshape(count, -1).argmax(1)
            good = gain.reshape(count, -1)[np.arange(count), best] > 1e-9
            for k in np.flatnonzero(good):
                f, b = divmod(int(best[k]), bins)
                feature[low + k], threshold[low + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, hessian, leaves) + ridge)
        raw += value[leaf]
        found.append((feature, threshold, value))
    model.feature, model.threshold, model.leaf = (np.array(a) for a in zip(*found, strict=True))
    return model


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % 3 == 1, F.lit(False))


def document_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and the array ``statistics`` of each document."""

    def measure(kept: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> dict:
        values = features(data, offsets)
        bounds = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
        return {"doc_id": kept.column("doc_id"), "statistics": pa.ListArray.from_arrays(bounds, pa.array(values.ravel()))}

    return map_texts(docs, ["doc_id"], "doc_id long, statistics array<double>", measure, text)


def learn(statistics: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees from at most ``sample_rows`` labelled rows that are not held out."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "quality")
    sample = (
        statistics.join(known, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample_rows)
        .select("statistics", "quality")
        .toPandas()
    )
    x = np.stack(sample["statistics"].to_list()) if len(sample) else np.zeros((0, len(FEATURES)))
    return grow(x, sample["quality"].to_numpy(np.float64))


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each document."""
    statistics = stored(document_statistics(docs))
    model = learn(statistics, labels, sample_rows)

    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(rows.to_list()))) if len(rows) else pd.Series([], dtype=float)

    return (
        statistics.withColumn("score", score("statistics"))
        .withColumn("held_out", held_out())
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .select("doc_id", "held_out", "score", "predicted")
    )
