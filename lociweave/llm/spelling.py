"""Spelling variants: words that differ by one edit, found through a reduced alphabet.

Every code point is hashed to one of ``SYMBOLS`` symbols, so a word becomes a reduced word, kept as a polynomial hash
of 64 bits.  Words one edit apart have reduced words at most one edit apart.  Each word posts the full one-edit
neighbourhood of its reduced word (itself, every deletion, replacement and insertion); the postings meet the reduced
vocabulary in a join, and whatever meets is verified on the original strings.  A hash that collides, of letters or
of words, only adds a candidate.  A neighbour's hash follows from the word's prefix sums, so a long word costs as
many numbers as it has neighbours, never copies of itself.

A word has one reduced word and posts each neighbour once, so a pair is met once from each side, and what is joined are
postings with words, never the members of a group with each other.  Words travel as row numbers until then.

Defined results: null and empty texts have no words; a null id counts as the empty text in the hash of an occurrence;
repeated rows count each time; a tie of counts goes to the word that is smallest by code points; an empty table
gives an empty one.  Other columns are left out, so their names do not matter.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lociweave.llm.common import cut_lineage, slices, utf8

LETTERS = re.compile("[a-zÀ-ÿ]+")
DELETE_EVERY = 199
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
SYMBOLS = 8
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
INVERSE = pow(BASE, -1, 1 << 64)
FLUSH_WORDS = 200_000
BLOCK_KEYS = 1 << 20


def runs(data: bytes, doc_id: str) -> Counter:
    """Occurrences of every word of a text: runs of letters, A-Z lowered, a letter lost where the hash says so."""
    prefix = zlib.crc32(doc_id.encode() + b":")
    counts: Counter = Counter()
    for run, n in Counter(LETTERS.findall(data.lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), prefix)
        if h % DELETE_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        counts[run] += n
    return counts


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough; counted in each task first."""

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for part in slices(batches, "text"):
            for doc_id, data in zip(part["id"].to_pylist(), part["text"].to_pylist()):
                for word, n in runs(data, doc_id).items():
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= FLUSH_WORDS:
                    yield batch(counts)
                    counts = Counter()
        if counts:
            yield batch(counts)

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), utf8("text").alias("text"))
    counts = texts.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


# --- reduced words


def symbols_of(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """Symbols 1 to ``symbols`` of words of one length, a row for each."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mixed = (points * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)
    return (mixed % np.uint64(symbols) + np.uint64(1)).reshape(len(words), -1)


def prefix_sums(reduced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and for each row the hashes of all beginnings of its reduced word (the last: the whole)."""
    powers = np.concatenate([[np.uint64(1)], np.full(reduced.shape[1], BASE, np.uint64)]).cumprod(dtype=np.uint64)
    sums = np.zeros((len(reduced), reduced.shape[1] + 1), np.uint64)
    np.cumsum(reduced * powers[:-1], axis=1, out=sums[:, 1:])
    return powers, sums


def reduced_keys(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """The hash of each reduced word; the words have one length."""
    return prefix_sums(symbols_of(words, symbols))[1][:, -1]


def neighbour_keys(words: list[str], symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words and hashes of all reduced words at most one edit from theirs, in blocks of positions.

    The words have one length.  Each neighbour comes once: a letter is deleted from the front of a run of equal ones
    and inserted behind it, and is not replaced by itself.
    """
    reduced = symbols_of(words, symbols)
    powers, sums = prefix_sums(reduced)
    rows, length = reduced.shape
    whole, alphabet = sums[:, -1:], np.arange(1, symbols + 1, dtype=np.uint64)
    yield np.arange(rows), whole[:, 0]
    size = max(1, BLOCK_KEYS // (2 * symbols * rows))
    for begin in range(0, length + 1, size):
        inside, at = slice(begin, min(begin + size, length)), slice(begin, begin + size)
        own = reduced[:, inside]
        before = np.concatenate([np.zeros((rows, 1), np.uint64), reduced], axis=1)[:, inside]
        behind = np.concatenate([reduced, np.zeros((rows, 1), np.uint64)], axis=1)[:, at]
        deleted = sums[:, inside] + (whole - sums[:, 1:][:, inside]) * np.uint64(INVERSE)
        replaced = whole[:, :, None] + (alphabet - own[:, :, None]) * powers[inside, None]
        inserted = (sums[:, at] + (whole - sums[:, at]) * np.uint64(BASE))[:, :, None] + alphabet * powers[at, None]
        for keys, wanted in ((deleted, own != before), (replaced, own[:, :, None] != alphabet), (inserted, behind[:, :, None] != alphabet)):
            yield np.nonzero(wanted)[0], keys[wanted]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places and words of each length, in blocks whose neighbourhoods fit in memory."""
    words = np.array(batch["word"].to_pylist(), object)
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        size = max(1, BLOCK_KEYS // (2 * SYMBOLS * (length + 1)))
        for i in range(0, len(places), size):
            yield places[i : i + size], words[places[i : i + size]].tolist()


def with_keys(words: DataFrame) -> DataFrame:
    """``key``, the reduced word, beside ``word`` and ``n``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, some in _by_length(batch):
                rows = batch.take(pa.array(places))
                yield pa.RecordBatch.from_arrays([pa.array(reduced_keys(some).view(np.int64)), rows["word"], rows["n"]], ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(work, "key long, word string, n long")


def neighbourhoods(words: DataFrame) -> DataFrame:
    """``key`` and ``id`` for every reduced word at most one edit from that of the word ``id``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["id"].to_numpy(zero_copy_only=False)
            for places, some in _by_length(batch):
                for owners, keys in neighbour_keys(some):
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids[places[owners]])], ["key", "id"])

    return words.select("id", "word").mapInArrow(work, "key long, id long")


def same_beginning(a: str, b: str) -> int:
    """The number of code points that both words begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point; in time linear in their length."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = same_beginning(a, b)
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def near_words(words: DataFrame) -> DataFrame:
    """``id``, ``n``, and ``near``, ``near_n`` for every ordered pair of words one edit apart.

    ``words`` (``id``, ``word``, ``n``) has to be written, so that its numbers stay.
    """

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = map(one_edit, batch["word"].to_pylist(), batch["near"].to_pylist())
            yield batch.filter(pa.array(keep, pa.bool_())).select(["id", "n", "near", "near_n"])

    vocabulary = with_keys(words).withColumnsRenamed({"word": "near", "n": "near_n"})
    met = neighbourhoods(words).join(vocabulary, "key").select("id", "near", "near_n")
    return met.join(words, "id").mapInArrow(verified, "id long, n long, near string, near_n long")


# --- forms


def with_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``n``, ``n_near``, and ``form``, ``form_n`` where the most frequent near word is frequent enough."""
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    near = near_words(words).groupBy("id").agg(F.count_distinct("near").alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    return words.join(near, "id", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"),
        F.when(enough, -F.col("best.minus")).alias("form_n"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of forms, for words that have a form.

    Counts grow along a chain by ``RATIO`` at least, so chains are short and have an end.  Each round doubles the
    way that is covered and moves only the words whose chain goes on.
    """
    links = cut_lineage(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = links.join(onward, "root", "left")
        moved = cut_lineage(longer.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of the corpus."""
    words = cut_lineage(word_counts(docs).withColumn("id", F.monotonically_increasing_id()))
    forms = cut_lineage(with_forms(words, ratio))
    ends = roots(forms)
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
