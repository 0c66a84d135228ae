"""Toxic passages by maximum-scoring segments.

Words get log-odds between toxic and other documents with Dirichlet priors: a word's prior comes from its beginning,
the prior of a beginning from the shares of the classes.  In a text every word without evidence costs a
little, and one linear scan finds all maximal segments.  Their scores follow an extreme-value law over
texts without toxic passages.  Its parameters turn each segment into an expected number of such segments by
chance and the best ones together (at most ``BEST_SEGMENTS``) into one chance; a logistic curve over its
logarithm gives the score.

Training uses at most ``SAMPLE_ROWS`` labelled rows of each class; four fifths of them give the log-odds, the rest the
calibration.  Defined results: null and empty texts have no segments and get the score of a text of
one word without evidence; without labelled rows of both classes every text gets the constant ``NO_MODEL``;
repeated rows stay repeated; an empty table gives an empty one.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import lgamma, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lociweave.llm.common import cut_lineage, fold, slices, utf8
from lociweave.llm.labelled import SAMPLE_ROWS, fit_logistic, labelled_documents, sampled_labels

FOLDS, HELD_OUT = 5, 0
WORD = re.compile(r"\w+")
BEGINNING = 4
PRIOR_DOCS = 5.0
LEXICON_TERMS = 50_000
EVIDENCE = 2.5
REPEAT_WITHIN = 64
DRIFT = 0.1
RATES = np.linspace(0.02, 3.0, 150)
NO_MODEL = 0.05
BEST_SEGMENTS = 200
CACHED_WORDS = 400_000


def words_of(data: bytes) -> list[str]:
    return WORD.findall(data.decode("utf-8", "replace").lower())


def maximal_segments(scores: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring runs of (begin, end, score) items, each of them as (begin, end, score).

    Keeps the candidates so far with the running totals before and after them.  A new positive item joins
    the nearest earlier candidate that began lower and ended lower than it does, and what lies between.
    """
    total, held = 0.0, []  # held: begin, end, total before, total after, nearest candidate that began lower
    for begin, end, score in scores:
        before, total = total, total + score
        if score <= 0:
            continue
        low, after = before, total
        at = len(held) - 1
        while True:
            while at >= 0 and held[at][2] >= low:
                at = held[at][4]
            if at < 0 or held[at][3] >= after:
                held.append((begin, end, low, after, at))
                break
            begin, low = held[at][0], held[at][2]
            del held[at:]
            at = len(held) - 1
    return [(b, e, after - low) for b, e, low, after, _ in held]


@dataclass
class Lexicon:
    """Log-odds of words and beginnings with evidence; everything else is neutral."""

    words: dict[str, float]
    beginnings: dict[str, float]
    cache: dict[str, float] = field(default_factory=dict)

    def score(self, word: str) -> float:
        value = self.words.get(word)
        if value is None:
            value = self.beginnings.get(word[:BEGINNING], 0.0) if len(word) > BEGINNING else 0.0
        return value if value >= EVIDENCE else 0.0

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int, float]], list[float]]:
        """Maximal segments in word places, and the scores of the words with evidence.

        A word counts again only after ``REPEAT_WITHIN`` words without it.
        """
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        cache, items, last, seen = self.cache, [], 0, {}
        values = list(map(cache.get, words))
        for i, value in enumerate(values):
            if value is None:
                value = values[i] = cache[words[i]] = self.score(words[i])
            if value:
                again = i - seen.get(words[i], -REPEAT_WITHIN) < REPEAT_WITHIN
                seen[words[i]] = i
                if again:  # saying a word over and over is no new evidence
                    continue
                if i > last:
                    items.append((last, i, -DRIFT * (i - last)))
                items.append((i, i + 1, value))
                last = i + 1
        if not items:
            return [], []
        return maximal_segments(items), [s for _, _, s in items if s > 0]


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    rate: float = 1.0  # of the extreme-value law
    size: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0
    constant: float | None = None

    def surprise(self, score: float, n_words: int) -> float:
        """Minus the logarithm of the number of segments of this score expected by chance."""
        return self.rate * score - log(self.size * max(n_words, 1))

    def evidence(self, scores: list[float], n_words: int) -> float:
        """Minus the logarithm of the chance of the best r segments together, for the r that makes it largest.

        The law of the sum of the r highest scores: exp(-t) t^(r-1) / (r! (r-1)!) for the sum t of surprises.
        """
        best, total = self.surprise(max(scores, default=0.0), n_words), 0.0
        for r, score in enumerate(sorted(scores, reverse=True), 1):
            gain = self.surprise(score, n_words)
            if gain <= 0:
                break
            total += gain
            best = max(best, total + lgamma(r + 1) + lgamma(r) - (r - 1) * log(max(total, 1.0)))
        return best

    def probability(self, scores: list[float], n_words: int) -> float:
        if self.constant is not None:
            return self.constant
        x = np.clip(self.intercept + self.slope * self.evidence(scores, n_words), -500, 500)
        return float(1 / (1 + np.exp(-x)))


def lexicon_part() -> Column:
    """True for the four fifths of the sampled rows that give the log-odds."""
    return F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id").cast("string")), F.lit(5)) != 0


def count_terms(labelled: DataFrame) -> DataFrame:
    """``term``, ``n0``, ``n1``: documents of each class with a word or (marked by a space) a beginning.

    Copies of a document must not pass for evidence.  So the words found before a term are kept as bits of a
    64-bit sketch, and a term counts for no more documents than it has different neighbours.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            sketch: tuple[dict, dict] = ({}, {})
            for data, label in zip(part["text"].to_pylist(), part["label"].to_pylist()):
                words = words_of(data)
                before = dict(zip(words[:0:-1], words[-2::-1])) | dict.fromkeys(words[:1], "")
                bits = {w: 1 << (crc32(v.encode()) & 63) for w, v in before.items()}
                starts = {" " + w[:BEGINNING]: b for w, b in bits.items() if len(w) > BEGINNING}
                own = sketch[label]
                for term, bit in (bits | starts).items():
                    own[term] = own.get(term, 0) | bit
                counts[label].update(bits.keys())
                counts[label].update(starts.keys())
            terms = list(counts[0].keys() | counts[1].keys())
            arrays = [pa.array(terms, pa.string())] + [pa.array([c[t] for t in terms], pa.int64()) for c in counts]
            arrays += [pa.array(np.array([m.get(t, 0) for t in terms], np.uint64).view(np.int64)) for m in sketch]
            yield pa.RecordBatch.from_arrays(arrays, ["term", "n0", "n1", "m0", "m1"])

    schema = "term string, n0 long, n1 long, m0 long, m1 long"
    rows = labelled.select(utf8("text").alias("text"), "label").mapInArrow(work, schema)
    sums = [F.sum(c).alias(c) for c in ("n0", "n1")] + [F.bit_or(c).alias(c) for c in ("m0", "m1")]
    merged = rows.groupBy("term").agg(*sums)

    def distinct(n: str, m: str) -> Column:
        empty = F.lit(64.0) - F.bit_count(m)
        return F.when(empty < 1, F.col(n)).otherwise(F.least(F.col(n), F.lit(-64.0) * F.log(empty / 64))).alias(n)

    return merged.select("term", distinct("n0", "m0"), distinct("n1", "m1"))


def log_odds(n0: float, n1: float, d0: int, d1: int, prior: float = 0.0) -> float:
    """Of a term in ``n0`` and ``n1`` of ``d0`` and ``d1`` documents, with ``PRIOR_DOCS`` documents of prior log-odds."""
    share = d1 / (d0 + d1)
    toxic = (n1 + PRIOR_DOCS * share * np.exp(prior)) / d1
    other = (n0 + PRIOR_DOCS * (1 - share)) / d0
    return float(np.log(toxic / other))


def build_lexicon(counts: DataFrame, d0: int, d1: int) -> Lexicon:
    """The ``LEXICON_TERMS`` words and as many beginnings with the strongest evidence, collected to the driver.

    Only terms that can reach ``EVIDENCE`` leave the executors: by themselves, or by a beginning that does.
    """
    share = d1 / (d0 + d1)
    toxic = (F.col("n1") + PRIOR_DOCS * share) / d1
    counts = counts.withColumn("odds", F.log(toxic / ((F.col("n0") + PRIOR_DOCS * (1 - share)) / d0)))
    counts = counts.where("n1 >= 2")
    starts = counts.where(F.col("term").startswith(" ") & (F.col("odds") >= EVIDENCE))
    starts = starts.orderBy(F.desc("odds"), "term").limit(LEXICON_TERMS).collect()
    beginnings = {r["term"][1:]: log_odds(r["n0"], r["n1"], d0, d1) for r in starts}
    known = counts.sparkSession.createDataFrame([(b,) for b in beginnings], "beginning string")
    # at most LEXICON_TERMS short strings
    words = counts.where(~F.col("term").startswith(" ")).join(
        F.broadcast(known), F.substring("term", 1, BEGINNING) == F.col("beginning"), "left"
    )
    words = words.where((F.col("odds") >= EVIDENCE) | F.col("beginning").isNotNull())
    found = {}
    for r in words.orderBy(F.desc("odds"), "term").limit(LEXICON_TERMS).collect():
        prior = max(0.0, beginnings.get(r["term"][:BEGINNING], 0.0)) if len(r["term"]) > BEGINNING else 0.0
        found[r["term"]] = log_odds(r["n0"], r["n1"], d0, d1, prior)
    return Lexicon(found, beginnings)


def background_rate(sums: np.ndarray, n_words: float) -> float:
    """The positive rate at which exp(rate * score) averages to one over the words of other documents."""
    means = sums / max(n_words, 1)
    above = np.flatnonzero(means >= 1)
    return float(RATES[above[0]]) if len(above) else float(RATES[-1])


def calibrate(labelled: DataFrame, lexicon: Lexicon) -> ToxicityModel:
    """Fit the extreme-value law on the other documents and the logistic curve on both classes."""
    shared = labelled.sparkSession.sparkContext.broadcast(lexicon)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            n_words, scores, sums = [], [], np.zeros(len(RATES))
            for data, label in zip(part["text"].to_pylist(), part["label"].to_pylist()):
                words = words_of(data)
                segments, hits = shared.value.scan(words)
                n_words.append(len(words))
                scores.append(sorted((s for *_, s in segments), reverse=True)[:BEST_SEGMENTS])
                if label == 0:
                    sums += (len(words) - len(hits)) * np.exp(-DRIFT * RATES) + np.exp(np.outer(RATES, hits)).sum(axis=1)
            arrays = [part["label"], part["weight"], pa.array(n_words, pa.int64())]
            arrays.append(pa.array(scores, pa.list_(pa.float64())))
            # the sums of the batch's other documents go with its first row
            arrays.append(pa.array([sums.tolist()] + [None] * (part.num_rows - 1), pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(arrays, ["label", "weight", "n_words", "scores", "sums"])

    schema = "label int, weight double, n_words long, scores array<double>, sums array<double>"
    rows = labelled.select(utf8("text").alias("text"), "label", "weight").mapInArrow(work, schema).toPandas()
    y = rows["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return ToxicityModel(lexicon, constant=NO_MODEL)
    sums = np.array([x for x in rows["sums"] if x is not None]).sum(axis=0)
    rate = background_rate(sums, float(rows["n_words"][y == 0].sum()))
    n_words = np.maximum(rows["n_words"].to_numpy(float), 1)
    best = np.array([max(x, default=0.0) for x in rows["scores"]])
    chance = (n_words * np.exp(-rate * best))[y == 0]
    model = ToxicityModel(lexicon, rate, len(chance) / max(chance.sum(), 1e-300))
    evidence = np.array([model.evidence(list(x), n) for x, n in zip(rows["scores"], rows["n_words"])])
    model.intercept, model.slope = fit_logistic(evidence[:, None], y, rows["weight"].to_numpy()).tolist()
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from the labelled rows outside the held-out fold (three passes over their texts)."""
    labelled = labelled_documents(docs, sampled_labels(labels, "toxic", FOLDS, HELD_OUT, rows))
    lexicon_docs = labelled.where(lexicon_part())
    sizes = {r["label"]: r["count"] for r in lexicon_docs.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel(Lexicon({}, {}), constant=NO_MODEL)
    # looked through twice, and far smaller than the texts it comes from
    lexicon = build_lexicon(cut_lineage(count_terms(lexicon_docs)), sizes[0], sizes[1])
    return calibrate(labelled.where(~lexicon_part()), lexicon)


def find_passages(docs: DataFrame, model: ToxicityModel, keep: list[str], at_most: float | None = None) -> DataFrame:
    """Columns ``keep`` of every row with ``passages`` and ``toxicity``, in one pass without a shuffle.

    A passage has its first and last character place and its score; those with fewer than one such passage expected
    by chance are listed.  With ``at_most`` only rows with a lower score stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches, "text", 4 << 20):
            scores, passages = [], []
            for data in part["text"].to_pylist():
                words = words_of(data)
                segments, _ = model.lexicon.scan(words)
                top = sorted((s for *_, s in segments), reverse=True)[:BEST_SEGMENTS]
                scores.append(model.probability(top, len(words)))
                sure = [x for x in segments if model.surprise(x[2], len(words)) > 0]
                if sure:
                    spans = [m.span() for m in WORD.finditer(data.decode("utf-8", "replace").lower())]
                    sure = [{"begin": spans[b][0], "end": spans[e - 1][1], "score": s} for b, e, s in sure]
                passages.append(sure)
            columns = [part[f"k{i}"] for i in range(len(keep))]
            columns += [pa.array(passages, passage), pa.array(scores, pa.float64())]
            out = pa.RecordBatch.from_arrays(columns, [f"k{i}" for i in range(len(keep))] + ["passages", "toxicity"])
            yield out if at_most is None else out.filter(pa.array([s < at_most for s in scores], pa.bool_()))

    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    types = [f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    schema = ", ".join([*types, "passages array<struct<begin:int,end:int,score:double>>", "toxicity double"])
    return docs.select(*kept, utf8("text").alias("text")).mapInArrow(work, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = find_passages(docs, train(docs, labels), ["doc_id"])
    return found.select(
        F.col("k0").alias("doc_id"),
        (fold("k0", FOLDS) == HELD_OUT).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows whose score is below the threshold, with all their columns."""
    found = find_passages(docs, train(docs, labels), docs.columns, threshold)
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
