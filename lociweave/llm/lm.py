"""Language-model scores of whole documents by a gated recurrent network in numpy.

Word counts of all training documents give the base score.  Their ``SHORTLIST`` most frequent words (and the end of
a text) are predicted by the network one by one.  All other words fall into ``BANDS`` bands of equal mass by their
frequency, the last of them for rare and unseen words; a band is predicted like a word, and within it a word has its
share of the base distribution.  So every word, seen or not, has a probability, and they add up to one.  The output is
factored: a softmax over classes and bands, then one over the words of a class.

Training runs on Spark: every task trains a copy of the network on its documents by backpropagation through windows
of ``WINDOW`` words, the state being carried from window to window, and the copies are averaged by the
number of words.  Every word of every training document takes part, in the counts and in the training.  Scoring
carries the state through each document from its first word to its end.

Defined results: a null or empty text is its end alone; without training documents all counts are 0 and the base
probability of any word is 1; a null id belongs to the training documents; repeated rows stay repeated; an
empty table gives an empty one.  Other columns are left out, so their names do not matter.
"""

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lociweave.llm.common import cut_lineage, fold, slices, utf8

FOLDS, HELD_OUT = 7, 2
END = b"\n"  # no word holds white space
HEAD_WORDS = 200_000
SHORTLIST = 1024
CLASSES = 32
BANDS = 8
HIDDEN = 16
WINDOW = 32
TRAIN_LANES = 256
LEAST_LANES = 32
SCORE_LANES = 512
ROUNDS = 1
LEAST_UPDATES, MOST_PASSES = 150, 6
LEARNING_RATE = 0.02
SLICE = 4096
TEXT_BYTES = 32 << 20
CODE_BYTES, SYMBOL_BYTES = 4 << 20, 10 << 20  # as many words in a slice of symbols as in TEXT_BYTES of text


def words_of(data: bytes) -> list[bytes]:
    """Words in A-Z lower case and the end of the text."""
    return [*data.lower().split(), END]


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as ``words_of`` has them, without the ends, and where each text's begin and the last one's end."""
    texts = texts.cast(pa.binary())
    # as text without a look at its encoding: only ASCII letters and white space matter
    text = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    words, edges = lists.values, lists.offsets.to_numpy()
    real = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), before[edges]


def as_text(words: list[bytes]) -> pa.Array:
    array = pa.array(words, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(array), array.buffers())


def as_bytes(words: pa.Array) -> pa.Array:
    return words.cast(pa.binary())


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``, its count over all training documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            counts = pc.value_counts(tokens(part["text"])[0])
            words = pa.concat_arrays([as_bytes(counts.field("values")), pa.array([END], pa.binary())])
            times = pa.concat_arrays([counts.field("counts").cast(pa.int64()), pa.array([part.num_rows], pa.int64())])
            yield pa.RecordBatch.from_arrays([words, times], ["word", "n"])

    training = docs.where(fold("doc_id", FOLDS) != HELD_OUT).select(utf8("text").alias("text"))
    return training.mapInArrow(work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = HEAD_WORDS) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``most``, by falling count; words of one count come all or not at all."""
    kept, least = 0, None
    for row in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(most).collect():
        kept += row["words"]
        if kept > most:
            break
        least = row["n"]
    if least is None:
        return []
    rows = counts.where(F.col("n") >= least).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))


@dataclass
class Lexicon:
    """Frequent words with their counts; the first ``short`` of them are predicted by the network."""

    place: dict[bytes, int]
    counts: np.ndarray
    total: int
    types: int
    short: int
    bands: np.ndarray  # places at which the bands of all other words begin

    @classmethod
    def of(cls, head: list[tuple[bytes, int]], total: int, types: int) -> "Lexicon":
        head = sorted(head, key=lambda x: x[0] != END)  # the end comes first
        counts = np.array([n for _, n in head], np.int64)
        short = min(SHORTLIST, len(head))
        bands = np.array([short])
        if len(head) > short:
            outside = total + types + 1 - (counts[:short] + 1).sum()
            bands = short + np.searchsorted(np.cumsum(counts[short:] + 1), outside * np.arange(BANDS) / BANDS)
        return cls({w: i for i, (w, _) in enumerate(head)}, counts, total, types, short, bands)

    @property
    def space(self) -> int:
        return self.total + self.types + 1

    def base(self) -> np.ndarray:
        """log10 base probability of each frequent word."""
        return np.log10((self.counts + 1) / self.space)

    def rest(self) -> np.ndarray:
        """Base probability of each band; the last holds all words that are not frequent, unseen ones included."""
        sums = np.concatenate([[0], np.cumsum(self.counts + 1)])[[*self.bands, len(self.counts)]]
        masses = np.diff(sums).astype(float)
        masses[-1] += self.space - sums[-1]
        return masses / self.space

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Places of the words, -1 for those that are not frequent."""
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int32, len(words))

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Places in the shortlist; all other words are the symbol of their band, after it."""
        bands = np.searchsorted(self.bands, codes, "right") - 1
        bands[codes < 0] = len(self.bands) - 1
        outside = (codes < 0) | (codes >= self.short)
        return np.where(outside, self.short + bands, codes).astype(np.int32)


# --- the network


class Network:
    """Parameters as named arrays; symbols are the shortlist, then the bands."""

    def __init__(self, lexicon: Lexicon, flat: np.ndarray | None = None):
        n = lexicon.short
        bands = len(lexicon.bands)
        self.n, self.symbols = n, n + bands
        self.classes = min(CLASSES, max(n, 1))
        self.width = -(-n // self.classes) if n else 0  # words of a class
        shapes = {
            "inputs": (self.symbols + 1, 3 * HIDDEN),  # the last row stands for the beginning of a text
            "recurrent": (HIDDEN, 3 * HIDDEN),
            "class_w": (HIDDEN, self.classes + bands),
            "class_b": (self.classes + bands,),
            "word_w": (n, HIDDEN),
            "word_b": (n,),
        }
        sizes = [int(np.prod(s)) for s in shapes.values()]
        self.flat = np.zeros(sum(sizes), np.float32) if flat is None else flat.astype(np.float32)
        at = np.cumsum([0, *sizes])
        self.p = {k: self.flat[a:b].reshape(s) for (k, s), a, b in zip(shapes.items(), at, at[1:])}
        if flat is None:
            rng = np.random.default_rng(7)
            for name in ("inputs", "recurrent", "class_w", "word_w"):
                self.p[name][:] = rng.normal(0, 0.1, self.p[name].shape)
            masses = (lexicon.counts[:n] + 1) / lexicon.space
            by_class = np.add.reduceat(masses, np.arange(0, n, self.width)) if n else np.zeros(0)
            filled = np.full(self.classes, 1e-12)
            filled[: len(by_class)] = by_class
            self.p["class_b"][:] = np.log(np.r_[filled, np.maximum(lexicon.rest(), 1e-12)])
            self.p["word_b"][:] = np.log(masses)

    def members(self, k: int) -> slice:
        return slice(k * self.width, min((k + 1) * self.width, self.n))

    def run(self, h: np.ndarray, inputs: np.ndarray, fresh: np.ndarray) -> "Window":
        """The states of a window, from the state before it and its symbols by time and lane.

        Nothing is allocated step by step, and the inputs' rows are fetched for the whole window at once.
        """
        steps, active = inputs.shape
        window = Window.empty(steps, active)
        given, recurrent = self.p["inputs"][inputs], self.p["recurrent"]
        mixed, begins = np.empty((active, 3 * HIDDEN), np.float32), fresh.any(axis=1)
        for i in range(steps):
            before, gates, new, state = window.befores[i], window.gates[i], window.new[i], window.states[i]
            before[:] = h
            if begins[i]:
                before[fresh[i]] = 0
            np.dot(before, recurrent, out=mixed)
            np.add(given[i, :, : 2 * HIDDEN], mixed[:, : 2 * HIDDEN], out=gates)
            gates *= 0.5  # the logistic curve by way of tanh
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            window.own[i] = mixed[:, 2 * HIDDEN :]
            np.multiply(gates[:, HIDDEN:], window.own[i], out=new)
            new += given[i, :, 2 * HIDDEN :]
            np.tanh(new, out=new)
            np.subtract(before, new, out=state)
            state *= gates[:, :HIDDEN]
            state += new
            h = state
        return window

    def log_probability(self, states: np.ndarray, targets: np.ndarray, back: dict | None = None) -> np.ndarray:
        """Natural logarithm of each target's probability; with ``back`` also the gradients of their sum."""
        kind = np.where(targets < self.n, targets // max(self.width, 1), self.classes + targets - self.n)
        result, slope = chosen(states @ self.p["class_w"] + self.p["class_b"], kind, back is not None)
        if back is not None:
            back["class_w"] += states.T @ slope
            back["class_b"] += slope.sum(axis=0)
            back["states"] = slope @ self.p["class_w"].T
        kind = kind.astype(np.int16)  # few enough, and sorted by digits
        order = np.argsort(kind, kind="stable")
        ends = np.searchsorted(kind[order], np.arange(self.classes + 1)).tolist()
        for k in range(self.classes):
            own = order[ends[k] : ends[k + 1]]
            if not len(own):
                continue
            part = self.members(k)
            weights, hidden = self.p["word_w"][part], states[own]
            inner, slope = chosen(hidden @ weights.T + self.p["word_b"][part], targets[own] - part.start, back is not None)
            result[own] += inner
            if back is not None:
                back["word_w"][part] += slope.T @ hidden
                back["word_b"][part] += slope.sum(axis=0)
                back["states"][own] += slope @ weights
        return result


@dataclass
class Window:
    """What the steps of a window leave behind, by time and lane."""

    befores: np.ndarray
    gates: np.ndarray  # how much of the state is kept, and how much of it the new one sees
    own: np.ndarray
    new: np.ndarray
    states: np.ndarray

    @classmethod
    def empty(cls, steps: int, active: int) -> "Window":
        widths = (HIDDEN, 2 * HIDDEN, HIDDEN, HIDDEN, HIDDEN)
        return cls(*[np.empty((steps, active, w), np.float32) for w in widths])


def chosen(logits: np.ndarray, places: np.ndarray, slope: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of one place of each row and, if asked for, its gradient; works in ``logits`` itself."""
    rows = np.arange(len(logits))
    # the largest of each row, by columns laid end to end: many times faster over short rows
    logits -= np.ascontiguousarray(logits.T).max(axis=0)[:, None]
    picked = logits[rows, places]
    np.exp(logits, out=logits)
    sums = logits.sum(axis=1)
    picked -= np.log(sums)
    if not slope:
        return picked, None
    logits /= -sums[:, None]
    logits[rows, places] += 1
    return picked, logits


@dataclass
class Lanes:
    """Texts laid one after another in parallel lanes, the longest lane first.

    The lanes lie end to end in flat arrays and are set side by side window by window, so a long text takes no more
    memory than its words.
    """

    flat: np.ndarray  # targets, lane after lane
    inputs: np.ndarray  # the symbol before each, or the start symbol where a text begins
    begins: np.ndarray  # of each lane in them
    lengths: np.ndarray
    start: int
    order: np.ndarray  # texts as they lie there
    places: np.ndarray  # where they begin

    @classmethod
    def pack(cls, texts: list[np.ndarray], n_lanes: int, start: int) -> "Lanes":
        queues: list[list[int]] = [[] for _ in range(min(n_lanes, max(len(texts), 1)))]
        heap = [(0, i) for i in range(len(queues))]
        for t in sorted(range(len(texts)), key=lambda t: -len(texts[t])):
            load, lane = heapq.heappop(heap)
            queues[lane].append(t)
            heapq.heappush(heap, (load + len(texts[t]), lane))
        loads = {lane: load for load, lane in heap}
        lanes = sorted(loads, key=lambda lane: -loads[lane])
        lengths = np.array([loads[x] for x in lanes])
        order = np.array([t for lane in lanes for t in queues[lane]], np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *[texts[t] for t in order]], dtype=np.int32)
        places = np.cumsum([0, *[len(texts[t]) for t in order]])[:-1]
        inputs = np.empty_like(flat)
        inputs[1:] = flat[:-1]
        inputs[places] = start
        return cls(flat, inputs, np.cumsum(lengths) - lengths, lengths, start, order, places)

    @property
    def targets(self) -> np.ndarray:
        """All targets by time and lane, -1 beyond a lane's end."""
        at, real = self.at(slice(0, int(self.lengths[0])), len(self.lengths))
        return np.where(real, self.flat[at], -1)

    def at(self, window: slice, active: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in the flat arrays by time and lane, and whether the lane is not over there."""
        t = np.arange(window.start, window.stop)[:, None]
        real = t < self.lengths[:active]
        return np.where(real, t + self.begins[:active], 0), real

    def view(self, window: slice, active: int) -> tuple[np.ndarray, ...]:
        """Places, whether a lane is not over, targets, inputs, and whether a text begins, by time and lane."""
        at, real = self.at(window, active)
        inputs = np.where(real, self.inputs[at], np.int32(self.start))
        return at, real, np.where(real, self.flat[at], np.int32(-1)), inputs, real & (inputs == self.start)

    def windows(self, size: int) -> Iterator[tuple[slice, int]]:
        """Runs of steps, and the number of lanes that are not over at their beginning."""
        steps = int(self.lengths[0])
        for t in range(0, steps, size):
            yield slice(t, min(t + size, steps)), int((self.lengths > t).sum())


def score_texts(net: Network, texts: list[np.ndarray]) -> np.ndarray:
    """Log probability of each text of symbols (natural logarithm)."""
    lanes = Lanes.pack(texts, SCORE_LANES, net.symbols)
    values = np.zeros(len(lanes.flat), np.float32)
    h = np.zeros((len(lanes.lengths), HIDDEN), np.float32)
    for window, active in lanes.windows(64):
        at, real, targets, inputs, fresh = lanes.view(window, active)
        states = net.run(h[:active], inputs, fresh).states
        h = states[-1]
        values[at[real]] = net.log_probability(states[real], targets[real])
    result = np.zeros(len(texts))
    result[lanes.order] = np.add.reduceat(values, lanes.places, dtype=np.float64)
    return result


def train_texts(net: Network, texts: list[np.ndarray]) -> None:
    """Adam steps on the mean log probability, one for each window of all lanes.

    There are as many lanes as the longest text leaves full, so that it does not go on alone for long; where most
    lanes are over, a step is as much smaller.
    """
    first, second, count = np.zeros_like(net.flat), np.zeros_like(net.flat), 0
    sizes = [len(t) for t in texts]
    lanes = Lanes.pack(texts, max(LEAST_LANES, min(TRAIN_LANES, sum(sizes) // max(sizes))), net.symbols)
    n_windows = -(-int(lanes.lengths[0]) // WINDOW)
    for _ in range(min(MOST_PASSES, max(1, -(-LEAST_UPDATES // n_windows)))):
        h = np.zeros((len(lanes.lengths), HIDDEN), np.float32)
        for window, active in lanes.windows(WINDOW):
            gradient, h = window_gradient(net, lanes, window, h[:active])
            count += 1
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient**2 - second)
            scale = np.sqrt(second / (1 - 0.99**count)) + 1e-6
            share = lanes.at(window, active)[1].sum() / (WINDOW * len(lanes.lengths))
            net.flat += share * LEARNING_RATE / (1 + count / 400) * (first / (1 - 0.9**count)) / scale


def window_gradient(net: Network, lanes: Lanes, window: slice, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the window's mean log probability, cut off at its beginning, and the state at its end."""
    active = len(h)
    _, real, targets, inputs, fresh = lanes.view(window, active)
    ran = net.run(h, inputs, fresh)
    befores, gates, own, new, states = ran.befores, ran.gates, ran.own, ran.new, ran.states
    steps, begins = len(states), fresh.any(axis=1)
    flat = np.zeros_like(net.flat)
    at, back = 0, {}
    for name, value in net.p.items():
        back[name] = flat[at : at + value.size].reshape(value.shape)
        at += value.size
    net.log_probability(states[real], targets[real], back)
    outer = np.zeros_like(states)
    outer[real] = back.pop("states")
    # what does not depend on the way back is worked out for the whole window at once
    keep, reset = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
    to_new = (1 - keep) * (1 - new * new)
    to_keep = (befores - new) * keep * (1 - keep)
    to_reset = own * reset * (1 - reset)
    carried, returned = np.zeros((active, HIDDEN), np.float32), np.empty((active, HIDDEN), np.float32)
    slopes = np.empty((steps, active, 3 * HIDDEN), np.float32)
    through = np.empty_like(slopes)
    weights = net.p["recurrent"].T.copy()
    for i in reversed(range(steps)):
        carried += outer[i]
        slope = slopes[i]
        on_new = slope[:, 2 * HIDDEN :]
        np.multiply(carried, to_new[i], out=on_new)
        np.multiply(carried, to_keep[i], out=slope[:, :HIDDEN])
        np.multiply(on_new, to_reset[i], out=slope[:, HIDDEN : 2 * HIDDEN])
        through[i] = slope
        through[i, :, 2 * HIDDEN :] *= reset[i]
        carried *= keep[i]
        np.dot(through[i], weights, out=returned)
        carried += returned
        if begins[i]:
            carried[fresh[i]] = 0
    back["recurrent"] += befores.reshape(-1, HIDDEN).T @ through.reshape(-1, 3 * HIDDEN)
    inputs = inputs.ravel().astype(np.int16)  # the shortlist, the bands and the start: sorted by digits
    order = np.argsort(inputs, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(inputs[order]) > 0])
    back["inputs"][inputs[order][starts]] = np.add.reduceat(slopes.reshape(-1, 3 * HIDDEN)[order], starts)
    flat /= max(int(real.sum()), 1)
    return flat, states[-1]


def coded(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Every text split and coded once: its ``symbols`` (two bytes each), its words that are not frequent (``rare``, each
    once, with its ``times``), and what the frequent ones add to its scores.

    ``task`` and ``row`` name a text; the rows have to be written before they are used twice.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        base, rest = lex.base(), np.log10(np.maximum(lex.rest(), 1e-300))
        task, row = TaskContext.get().partitionId(), 0
        known_words = as_text(list(lex.place))
        end = np.int32(lex.place.get(END, -1))
        for part in slices(batches, "text", CODE_BYTES):
            words, edges = tokens(part["text"])
            places = pc.fill_null(pc.index_in(words, value_set=known_words), -1).to_numpy().astype(np.int32)
            unknown = np.flatnonzero(places < 0)
            rare_words = as_bytes(words.take(pa.array(unknown))).to_pylist()
            rare_edges = np.searchsorted(unknown, edges)
            out = {name: [] for name in ("n_tokens", "n_known", "head_base", "share", "symbols", "rare", "times")}
            for i in range(part.num_rows):
                codes = np.append(places[edges[i] : edges[i + 1]], end)
                known, symbols = codes[codes >= 0], lex.symbols(codes)
                in_bands = np.bincount(symbols[symbols >= lex.short] - lex.short, minlength=len(rest))
                out["n_tokens"].append(len(codes))
                out["n_known"].append(len(known))
                out["head_base"].append(float(base[known].sum()))
                # a word outside the shortlist has its share of what the network gives to its band
                out["share"].append(float(base[known[known >= lex.short]].sum()) - float(rest @ in_bands))
                out["symbols"].append(symbols.astype(np.uint16).tobytes())
                rare = Counter(rare_words[rare_edges[i] : rare_edges[i + 1]])
                if end < 0:
                    rare[END] = 1
                out["rare"].append(list(rare))
                out["times"].append(list(rare.values()))
            n = part.num_rows
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]
            columns = [part["id"], part["training"], pa.array([task] * n, pa.int32()), pa.array(range(row, row + n), pa.int64())]
            columns += [pa.array(values, kind) for values, kind in zip(out.values(), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "training", "task", "row", *out])
            row += n

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, training boolean, task int, row long, n_tokens long, n_known long, head_base double, share double"
    training = (fold("doc_id", FOLDS) != HELD_OUT).alias("training")
    rows = docs.select(F.col("doc_id").alias("id"), training, utf8("text").alias("text"))
    return rows.mapInArrow(work, f"{schema}, symbols binary, rare array<binary>, times array<int>")


def symbols_of(part: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16).astype(np.int32) for x in part["symbols"].to_pylist()]


def train(texts: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Parameters after ``ROUNDS`` rounds of training in every task and averaging; ``texts`` are coded."""
    spark = texts.sparkSession
    training = texts.where("training").select("symbols")
    flat = Network(lexicon).flat
    if not lexicon.short:
        return flat
    shared_lexicon = spark.sparkContext.broadcast(lexicon)
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(flat)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net, words = Network(shared_lexicon.value, shared.value.copy()), 0
            for part in slices(batches, "symbols", SYMBOL_BYTES):
                texts = symbols_of(part)
                train_texts(net, texts)
                words += sum(map(len, texts))
            if words:
                parts = np.array_split(net.flat, -(-len(net.flat) // SLICE))
                columns = [list(range(len(parts))), [words] * len(parts), [p.tobytes() for p in parts]]
                types = [pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, words = {}, Counter()
            for batch in batches:
                for row in batch.to_pylist():
                    k, n = row["part"], row["words"]
                    sums[k] = sums.get(k, 0) + np.frombuffer(row["data"], np.float32).astype(np.float64) * n
                    words[k] += n
            columns = [list(sums), [words[k] for k in sums], [(v / words[k]).astype(np.float32).tobytes() for k, v in sums.items()]]
            types = [pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        names = ["part", "words", "data"]
        schema = "part int, words long, data binary"
        copies = training.mapInArrow(work, schema).repartition("part")
        rows = sorted(copies.mapInArrow(average, schema).collect(), key=lambda r: r["part"])
        if rows:
            flat = np.concatenate([np.frombuffer(r["data"], np.float32) for r in rows])
    return flat


def score_documents(docs: DataFrame) -> DataFrame:
    """Contract columns of every document, and ``n_rare``, its words outside the frequent ones."""
    spark = docs.sparkSession
    counts = cut_lineage(word_counts(docs))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("types")).first()
    lexicon = Lexicon.of(frequent_words(counts), sums["total"], sums["types"])
    texts = cut_lineage(coded(docs, lexicon))
    flat = train(texts, lexicon)
    shared = spark.sparkContext.broadcast((lexicon, flat))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(*shared.value)
        for part in slices(batches, "symbols", SYMBOL_BYTES):
            network = score_texts(net, symbols_of(part)) / np.log(10)
            yield pa.RecordBatch.from_arrays([*[part[c] for c in kept], pa.array(network)], [*kept, "network"])

    kept = ["doc_id", "task", "row", "n_tokens", "n_known", "head_base", "share"]
    schema = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in kept) + ", network double"
    scored = texts.select(*kept, "symbols").mapInArrow(work, schema)
    # a text's words that are not frequent get their counts by a join, each word once a text
    words = texts.select("task", "row", F.explode(F.arrays_zip("rare", "times")).alias("e"))
    words = words.select("task", "row", F.col("e.rare").alias("word"), F.col("e.times").cast("long").alias("times"))
    found = words.join(counts, "word", "left")
    logs = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(lexicon.space)))
    rare = found.groupBy(F.col("task").alias("_task"), F.col("row").alias("_row")).agg(
        F.sum(F.col("times") * logs).alias("rare"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum("times").alias("n_rare"),
    )
    joined = scored.join(rare, (F.col("task") == F.col("_task")) & (F.col("row") == F.col("_row")), "left")
    none = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", none)).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("rare", F.lit(0.0))).alias("base_score"),
        (F.col("network") + F.col("share") + F.coalesce("rare", F.lit(0.0))).alias("score"),
        F.coalesce("n_rare", none).alias("n_rare"),
    )
