"""BPE encoding and decoding by forced boundaries.

Two neighbouring bytes that no vocabulary token holds side by side can never end up in one token.  So each
pre-token is cut at such places first, its fragments are merged on their own, and their ids are put
one after the other.  Ids are kept packed, as little-endian unsigned 32-bit numbers.

Defined results: a null or empty text has no ids; strings of added tokens inside a text become those
tokens; bytes that are not UTF-8 are replaced before encoding; repeated rows stay repeated; an empty table
gives an empty one.  Other columns are left out, so their names do not matter.
"""

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lociweave.llm.common import slices, utf8
from lociweave.llm.vocab import Vocabulary, parsed, pretokens, read_source

CACHED_PRETOKENS = 600_000
CACHED_LENGTH = 48
LONG_FRAGMENT = 96
NEVER = 1 << 60


class Encoder(dict):
    """Packed ids by pre-token, found when first asked for and kept within bounds."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.rank = {pair: i for i, pair in enumerate(vocabulary.pairs)}
        self.forced = (~vocabulary.joined_bytes()).tolist()
        self.byte_ids = vocabulary.byte_ids
        self.byte_rank = [self.rank.get(a << 32 | b, NEVER) for a in self.byte_ids for b in self.byte_ids]
        self.packed = [i.to_bytes(4, "little") for i in range(len(vocabulary.tokens))]
        self.added = {s: i.to_bytes(4, "little") for s, i in vocabulary.added.items()}

    def __missing__(self, pretoken: str) -> bytes:
        data = pretoken.encode()
        packed = b"".join([self.packed[i] for i in self.encode_pretoken(data)])
        if len(data) <= CACHED_LENGTH:
            if len(self) >= CACHED_PRETOKENS:
                self.clear()
            self[pretoken] = packed
        return packed

    def encode_pretoken(self, data: bytes) -> list[int]:
        """Ids of the fragments between forced boundaries, one after the other."""
        codes = [a << 8 | b for a, b in zip(data, data[1:])]
        ids = [self.byte_ids[b] for b in data]
        ranks = [self.byte_rank[c] for c in codes]
        cuts = [i for i, forced in enumerate(map(self.forced.__getitem__, codes), 1) if forced]
        if not cuts:
            return self.merge(ids, ranks)
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(ids)]):
            out += self.merge(ids[a:b], ranks[a : b - 1])
        return out

    def merge(self, ids: list[int], ranks: list[int]) -> list[int]:
        """Merge the leftmost pair of lowest rank until no pair has a rank; only its neighbours are ranked anew."""
        if len(ids) > LONG_FRAGMENT:
            return self.merge_long(ids)
        rank, merged = self.rank.get, self.vocabulary.merged
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            ids[i] = merged[best]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(ids[i] << 32 | ids[i + 1], NEVER)
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 32 | ids[i], NEVER)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same result by a heap of pairs over a linked list, for fragments of any length."""
        rank, merged, n = self.rank.get, self.vocabulary.merged, len(ids)
        left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] < n:
                r = rank(ids[i] << 32 | ids[right[i]], NEVER)
                if r != NEVER:
                    heap.append((r, i)) if not ready else heapq.heappush(heap, (r, i))

        ready = False
        for i in range(n - 1):
            offer(i)
        heapq.heapify(heap)
        ready = True
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or right[i] >= n or rank(ids[i] << 32 | ids[right[i]], NEVER) != r:
                continue
            gone = right[i]
            ids[i], alive[gone], right[i] = merged[r], False, right[gone]
            if right[i] < n:
                left[right[i]] = i
            offer(left[i])
            offer(i)
        return [x for x, kept in zip(ids, alive) if kept]

    def encode(self, text: str) -> bytes:
        sections = self.vocabulary.sections(text)
        if len(sections) == 1:
            return b"".join(map(self.__getitem__, pretokens(text)))
        return b"".join(
            self.added[s] if i % 2 else b"".join(map(self.__getitem__, pretokens(s))) for i, s in enumerate(sections)
        )


@lru_cache(maxsize=2)
def encoder(source: str) -> Encoder:
    return Encoder(parsed(source))


def decode_ids(vocabulary: Vocabulary, packed: bytes) -> str:
    """The text of packed ids; bytes that are not UTF-8 become replacement characters."""
    ids = np.frombuffer(packed, "<u4").tolist()
    return b"".join(map(vocabulary.tokens.__getitem__, ids)).decode("utf-8", "replace")


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    decoded: bool = False,
) -> DataFrame:
    """``id_col``, ``ids`` (packed) and, if asked for, ``decoded``: the text read back from those ids.

    One pass over the rows without a shuffle; a task holds about 1 MB of text and its ids at a time.
    """
    source = docs.sparkSession.sparkContext.broadcast(read_source(vocabulary))
    id_type = docs.schema[id_col].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(source.value)
        for part in slices(batches, "text"):
            packed = [enc.encode(x.decode("utf-8", "replace")) for x in part["text"].to_pylist()]
            columns = [part["id"], pa.array(packed, pa.binary())]
            if decoded:
                columns.append(pa.array([decode_ids(enc.vocabulary, x) for x in packed], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "ids", "decoded"][: 2 + decoded]
    schema = f"`{id_col}` {id_type.simpleString()}, ids binary" + ", decoded string" * decoded
    return docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")).mapInArrow(work, schema)


def decode_documents(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None
) -> DataFrame:
    """``id_col`` and ``decoded`` for rows of packed ids (null counts as none)."""
    source = encoded.sparkSession.sparkContext.broadcast(read_source(vocabulary))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = parsed(source.value)
        for part in slices(batches, "ids"):
            texts = [decode_ids(vocab, x or b"") for x in part["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["id"], pa.array(texts, pa.string())], [id_col, "decoded"])

    schema = f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, decoded string"
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(work, schema)


def unpacked(ids: Column | str) -> Column:
    """Packed ids as an array of numbers."""
    text = F.hex(ids)
    at = F.sequence(F.lit(0), (F.length(text) / 8 - 1).cast("int"))
    swapped = F.transform(
        at, lambda i: F.concat(*[F.substring(text, i * 8 + 7 - 2 * k, F.lit(2)) for k in range(4)])
    )
    return F.when(F.length(text) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(swapped, lambda x: F.conv(x, 16, 10).cast("bigint"))
    )


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per document the number of tokens and digests of its ids and of the text decoded from them."""
    both = encode_documents(docs, vocabulary=vocabulary, decoded=True)
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
