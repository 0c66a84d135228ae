"""Text quality by a sparse ensemble of rules.

Each text becomes a row of statistics.  Shallow boosted trees are grown on a bounded sample of labelled rows;
every path from a root is a rule, a conjunction of thresholds.  A lasso-penalized logistic fit keeps few of the rules,
and those are compiled into one Spark column expression over the statistics.

Training uses at most ``SAMPLE_ROWS`` labelled rows of each class, outside the held-out fold.  Defined results: null and
empty texts have statistics of zero and are scored by the rules like any other; without labelled rows of
both classes every text gets the constant ``NO_MODEL``; repeated rows stay repeated; an empty table gives an
empty one.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lociweave.llm.common import fold, slices, utf8
from lociweave.llm.labelled import SAMPLE_ROWS, labelled_documents, sampled_labels, sigmoid

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
NO_MODEL = 1.0
TREES, DEPTH, BINS, SHRINKAGE, LEAF_SHARE = 16, 3, 32, 0.4, 0.002
PENALTIES = [0.003, 0.001, 0.0003, 0.0001]

STATISTICS = [
    "log_words", "word_bytes", "distinct_words", "top_word", "repeated_words", "upper_letters", "digits", "symbols",
    "stops", "exclamations", "other_bytes", "lines_a_word", "distinct_lines", "log_line_bytes", "bars", "short_words",
]
_GROUPS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "stop": b".,;:?!",
    "exclamation": b"!",
    "bar": b"|",
    "space": b" \t\n\r\x0b\x0c",
}
_MEMBERS = np.array([[b in chars for b in range(256)] for chars in _GROUPS.values()], np.float64)


def statistics(data: bytes) -> list[float]:
    """The values of ``STATISTICS`` for one text."""
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower, digit, symbol, stop, exclamation, bar, space = (_MEMBERS @ bytes_of).tolist()
    n, size = len(words), len(data)
    filled = size - space
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x]
    return [
        float(np.log1p(n)),
        filled / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        upper / max(upper + lower, 1),
        digit / filled,
        symbol / filled,
        stop / n,
        exclamation / n,
        float(bytes_of[128:].sum()) / filled,
        len(lines) / n,
        len(set(lines)) / max(len(lines), 1),
        float(np.log1p(size / max(len(lines), 1))),
        bar / n,
        sum(c for w, c in counts.items() if len(w) < 4) / n,
    ]


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` as k0, k1, … and the statistics as s0, s1, …, in one pass without a shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            rows = np.array([statistics(x) for x in part["text"].to_pylist()], np.float64)
            columns = [part[f"k{i}"] for i in range(len(keep))]
            columns += [pa.array(np.ascontiguousarray(rows[:, j])) for j in range(len(STATISTICS))]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [f"k{i}" for i in range(len(keep))] + [f"s{j}" for j in range(len(STATISTICS))]
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    types = [docs.schema[c].dataType.simpleString() for c in keep] + ["double"] * len(STATISTICS)
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types))
    return docs.select(*kept, utf8("text").alias("text")).mapInArrow(work, schema)


# --- rules

Condition = tuple[int, bool, float]  # statistic, above or not, threshold


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]]

    def column(self) -> Column:
        """The probability of good quality as an expression over s0, s1, …"""
        terms = [F.lit(self.intercept)]
        for conditions, weight in self.rules:
            holds = [F.col(f"s{j}") > t if above else F.col(f"s{j}") <= t for j, above, t in conditions]
            terms.append(F.when(reduce(lambda a, b: a & b, holds), F.lit(weight)).otherwise(F.lit(0.0)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(lambda a, b: a + b, terms)))


def applies(conditions: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, j] > t) == above for j, above, t in conditions])


def grow_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[tuple[Condition, ...]]:
    """The paths of boosted trees: each node but the roots is a rule."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    margin = np.full(len(y), np.log((weight @ y) / (weight @ (1 - y))))
    smallest = LEAF_SHARE * weight.sum()
    rules: dict[tuple[Condition, ...], None] = {}

    def split(rows: np.ndarray, path: tuple[Condition, ...], g: np.ndarray, h: np.ndarray, values: np.ndarray) -> None:
        best = (1e-9, 0, 0)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        if len(path) < DEPTH:
            for j in range(x.shape[1]):
                size = len(cuts[j]) + 1
                sums = [np.bincount(binned[rows, j], v[rows], size).cumsum()[:-1] for v in (g, h, weight)]
                low_g, low_h, low_w = sums
                high_w = weight[rows].sum() - low_w
                gain = low_g**2 / (low_h + 1) + (total_g - low_g) ** 2 / (total_h - low_h + 1)
                gain = np.where((low_w >= smallest) & (high_w >= smallest), gain - total_g**2 / (total_h + 1), 0)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), j, int(gain.argmax()))
        if path:
            rules.setdefault(tuple(sorted(path)))
        if best[0] <= 1e-9:
            values[rows] = total_g / (total_h + 1)
            return
        _, j, at = best
        high = binned[rows, j] > at
        for above, part in ((False, rows[~high]), (True, rows[high])):
            split(part, (*path, (j, above, float(cuts[j][at]))), g, h, values)

    for _ in range(TREES):
        p = sigmoid(margin)
        values = np.zeros(len(y))
        split(np.arange(len(y)), (), weight * (y - p), weight * p * (1 - p), values)
        margin += SHRINKAGE * values
    return list(rules)


def lasso_logistic(a: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, steps: int = 400) -> np.ndarray:
    """Intercept and lasso-penalized weights by accelerated proximal gradient steps."""
    share = weight / weight.sum()
    full = np.column_stack([np.ones(len(a)), a])
    rate = 4 / np.linalg.norm((full * share[:, None]).T @ full, 2)
    w = z = np.zeros(full.shape[1])
    momentum = 1.0
    for _ in range(steps):
        step = z - rate * (full.T @ (share * (sigmoid(full @ z) - y)))
        after = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        after[0] = step[0]
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        z = after + (momentum - 1) / faster * (after - w)
        w, momentum = after, faster
    return w


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> RuleModel:
    """Grow rules on four fifths of the rows, choose the penalty on the rest, and keep the rules with a weight."""
    if len(set(y.tolist())) < 2:
        return RuleModel(50.0 if NO_MODEL == 1.0 else 0.0, [])
    test = np.arange(len(y)) % 5 == 4
    if min(len(set(y[test].tolist())), len(set(y[~test].tolist()))) < 2:
        test = np.zeros(len(y), bool)
    rules = grow_rules(x[~test], y[~test], weight[~test])
    held = np.column_stack([applies(r, x) for r in rules]).astype(float) if rules else np.zeros((len(y), 0))
    best = None
    for penalty in PENALTIES:
        w = lasso_logistic(held[~test], y[~test], weight[~test], penalty)
        loss = 0.0
        if test.any():
            p = np.clip(sigmoid(w[0] + held[test] @ w[1:]), 1e-9, 1 - 1e-9)
            loss = -(weight[test] * (y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p))).sum() / weight[test].sum()
        if best is None or loss < best[0]:
            best = (loss, w)
    w = best[1]
    return RuleModel(float(w[0]), [(r, float(v)) for r, v in zip(rules, w[1:]) if abs(v) > 1e-6])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> RuleModel:
    """Learn from the labelled rows outside the held-out fold; their statistics come to the driver."""
    labelled = labelled_documents(docs, sampled_labels(labels, "quality", FOLDS, HELD_OUT, rows))
    stats = with_statistics(labelled, ["doc_id", "label", "weight"]).orderBy("k0", "s0", "s1").toPandas()
    x = stats[[f"s{j}" for j in range(len(STATISTICS))]].to_numpy(float)
    return fit(x, stats["k1"].to_numpy(float), stats["k2"].to_numpy(float))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    scored = with_statistics(docs, ["doc_id"]).withColumn("score", model.column())
    return scored.select(
        F.col("k0").alias("doc_id"),
        (fold("k0", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    model = train(docs, labels)
    good = with_statistics(docs, docs.columns).where(model.column() >= threshold)
    return good.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
