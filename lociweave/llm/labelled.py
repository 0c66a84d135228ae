"""Bounded samples of labelled rows, and small numeric fits on them."""

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lociweave.llm.common import fold

SAMPLE_ROWS = 20_000


def sampled_labels(labels: DataFrame, column: str, folds: int, held_out: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``label`` and ``weight`` of at most ``rows`` training documents of each class (0 and 1).

    Rows of the held-out fold, null ids and other labels are left out; of several labels of one document the largest
    counts.  The sample is the same whenever it is taken: the rows with the smallest hashes.  A weight is the number
    of documents a row stands for.  With at most twice ``rows`` rows of three numbers the sample can be broadcast
    whatever the size of the table.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & (fold("doc_id", folds) != held_out))
    each = usable.groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label"))
    totals = {r["label"]: r["count"] for r in each.groupBy("label").count().collect()}
    parts = [
        each.where(F.col("label") == k)
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
        .limit(rows)
        .withColumn("weight", F.lit(max(1.0, totals.get(k, 0) / rows)))
        for k in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def labelled_documents(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``label`` and ``weight`` of the sampled documents; the texts are not shuffled."""
    small = F.broadcast(sample.withColumnRenamed("doc_id", "labelled_id"))
    joined = docs.select("doc_id", "text").join(small, F.col("doc_id") == F.col("labelled_id"))
    return joined.select("doc_id", "text", "label", "weight")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 50
) -> np.ndarray:
    """Intercept and weights by damped Newton steps with a small ridge penalty."""
    share = weight / weight.sum()
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    ridge = penalty * np.eye(a.shape[1])
    for _ in range(steps):
        p = sigmoid(a @ w)
        gradient = a.T @ (share * (p - y)) + ridge @ w
        hessian = (a * (share * p * (1 - p))[:, None]).T @ a + ridge
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w
