"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch become one flat array of symbols with the sequence each symbol belongs
to.  In every round each sequence finds its lowest-ranked pair, and all sequences merge theirs at
the same time; sequences without a ranked pair leave with the number of symbols they have kept.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings of added tokens inside a text
count as one token each; bytes that are not UTF-8 are replaced before counting; repeated rows stay repeated;
an empty table gives an empty one.  Other columns are left out, so their names do not matter.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lociweave.llm.common import slices, utf8
from lociweave.llm.vocab import Vocabulary, parsed, pretokens, read_source

CACHED_PRETOKENS = 500_000
CACHED_LENGTH = 48
NO_RANK = np.int32(2**31 - 1)


class SymbolCounter:
    def __init__(self, vocabulary: Vocabulary):
        order = np.argsort(np.array(vocabulary.pairs, np.int64), kind="stable")
        self.pairs = np.array(vocabulary.pairs, np.int64)[order]
        self.ranks = order.astype(np.int32)
        self.merged = np.array(vocabulary.merged, np.int64)
        self.byte_ids = np.array(vocabulary.byte_ids, np.int64)
        grid = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.byte_rank = self.rank_of(*grid)  # by first byte * 256 + second
        self.vocabulary = vocabulary
        self.known: dict[str, int] = {}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NO_RANK)

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left in each sequence after all merges."""
        result = np.array([len(s) for s in sequences], np.int64)
        number = np.flatnonzero(result > 1)
        sizes = result[number]
        codes = np.frombuffer(b"".join([sequences[i] for i in number]), np.uint8).astype(np.int32)
        symbols = self.byte_ids[codes]
        ranks = np.full(len(symbols), NO_RANK)
        if len(symbols):
            ranks[:-1] = self.byte_rank[codes[:-1] << 8 | codes[1:]]
            ranks[np.cumsum(sizes) - 1] = NO_RANK  # the last symbol of a sequence has no right neighbour
        while len(number):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NO_RANK
            if done.any():
                result[number[done]] = sizes[done]
                stay = np.repeat(~done, sizes)
                symbols, ranks = symbols[stay], ranks[stay]
                number, sizes, lowest = number[~done], sizes[~done], lowest[~done]
                if not len(number):
                    break
            owner = np.repeat(np.arange(len(number)), sizes)
            hits = np.flatnonzero((ranks == lowest[owner]) & (ranks != NO_RANK))
            # in a run of overlapping pairs, as in aaaa, every other one merges, from the left
            first = np.r_[True, np.diff(hits) > 1]
            begun = np.maximum.accumulate(np.where(first, hits, 0))
            hits = hits[(hits - begun) % 2 == 0]
            symbols[hits] = self.merged[ranks[hits]]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            sizes = sizes - np.bincount(owner[hits], minlength=len(sizes))
            place = np.cumsum(keep) - 1
            hits = place[hits]
            symbols, ranks, owner = symbols[keep], ranks[keep], owner[keep]
            self._renew(symbols, ranks, owner, hits)
        return result

    def _renew(self, symbols: np.ndarray, ranks: np.ndarray, owner: np.ndarray, changed: np.ndarray) -> None:
        """Ranks of the pairs that begin or end at a changed symbol."""
        at = np.r_[changed, changed[changed > 0] - 1]
        ranks[at] = NO_RANK
        at = at[at < len(symbols) - 1]
        at = at[owner[at] == owner[at + 1]]
        ranks[at] = self.rank_of(symbols[at], symbols[at + 1])

    def learn(self, pieces: list[str]) -> dict[str, int]:
        """Counts of pieces that are not known yet; the short ones are kept, within bounds."""
        counts = dict(zip(pieces, self.count([p.encode() for p in pieces]).tolist()))
        if len(self.known) + len(pieces) > CACHED_PRETOKENS:
            self.known.clear()
        self.known.update((p, c) for p, c in counts.items() if len(p) <= CACHED_LENGTH)
        return counts

    def totals(self, texts: list[str]) -> list[int]:
        """Tokens of each text: what is known is added up, the rest is merged together."""
        totals, open_pieces = [], []
        for text in texts:
            sections = self.vocabulary.sections(text)
            pieces = pretokens(text) if len(sections) == 1 else [p for s in sections[::2] for p in pretokens(s)]
            counts = list(map(self.known.get, pieces))
            new = [p for p, c in zip(pieces, counts) if c is None] if None in counts else []
            totals.append(len(sections) // 2 + sum(filter(None, counts)))
            open_pieces.append(new)
        found = self.learn(list(set(chain.from_iterable(open_pieces))))
        return [n + sum(map(found.__getitem__, new)) for n, new in zip(totals, open_pieces)]


@lru_cache(maxsize=2)
def counter(source: str) -> SymbolCounter:
    return SymbolCounter(parsed(source))


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    limit: int = 512,
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    One pass without a shuffle; a task holds about 4 MB of text and its new pre-tokens at a time.
    """
    source = docs.sparkSession.sparkContext.broadcast(read_source(vocabulary))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(source.value)
        for part in slices(batches, "text", 4 << 20):
            totals = own.totals([x.decode("utf-8", "replace") for x in part["text"].to_pylist()])
            columns = [part["id"], part["n_bytes"], pa.array(totals, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_bytes", "n_tokens"])

    text = utf8(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.length(text).cast("long").alias("n_bytes"), text.alias("text"))
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long"
    return rows.mapInArrow(work, schema).withColumn("over_limit", F.col("n_tokens") > limit)
