"""A byte-level BPE vocabulary file and its pre-tokens."""

import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex

DEFAULT_VOCABULARY = "byte_bpe_50k.json"

# The public pre-token pattern, and the code points that newer character tables call
# letters or numbers while the tokenizer's own tables do not know them yet.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{LN}]+|\s+(?!\S)|\s+"
UNKNOWN_YET = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]


def _class(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


_ODD = regex.compile(f"[{_class(UNKNOWN_YET)}]")
_PLAIN = regex.compile(PRETOKEN.format(L=r"\p{L}", N=r"\p{N}", LN=r"\p{L}\p{N}"))
_EXACT = regex.compile(
    "(?V1)"
    + PRETOKEN.format(
        L=rf"[\p{{L}}--[{_class(UNKNOWN_YET)}]]",
        N=rf"[\p{{N}}--[{_class(UNKNOWN_YET)}]]",
        LN=rf"[\p{{L}}\p{{N}}--[{_class(UNKNOWN_YET)}]]",
    )
)


def pretokens(text: str) -> list[str]:
    """The pieces that merges never cross, in order; joined they are the text."""
    try:
        text.encode("latin-1")  # far faster than a search, and most texts pass
    except UnicodeEncodeError:
        if _ODD.search(text):
            return _EXACT.findall(text)
    return _PLAIN.findall(text)


def shown_bytes() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file.

    Printable characters of Latin-1 stand for themselves, the other bytes take the code points from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, merges by rank, and the strings of added tokens."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, as_byte = spec["model"], shown_bytes()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*model["vocab"].values(), *self.added.values()])
        self.tokens: list[bytes] = [b""] * size
        for shown, i in model["vocab"].items():
            self.tokens[i] = bytes(as_byte[c] for c in shown)
        for text, i in self.added.items():
            self.tokens[i] = text.encode()
        ids = model["vocab"]
        self.byte_ids = [ids[c] for c, _ in sorted(as_byte.items(), key=lambda x: x[1])]
        # a pair of token ids is one number; its rank is its place in the list
        self.pairs = [(ids[a] << 32) | ids[b] for a, b in model["merges"]]
        self.merged = [ids[a + b] for a, b in model["merges"]]
        parts = sorted(self.added, key=len, reverse=True)
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, parts)) + ")") if parts else None

    def sections(self, text: str) -> list[str]:
        """Text and added tokens in turn: the odd places hold strings of added tokens."""
        if self.splitter is None:
            return [text]
        return self.splitter.split(text)

    def joined_bytes(self) -> np.ndarray:
        """For each pair of bytes (first * 256 + second): does any token hold it?"""
        inside = np.zeros(65536, bool)
        for token in self.tokens:
            for a, b in zip(token, token[1:]):
                inside[a << 8 | b] = True
        return inside


def read_source(path: str | None = None) -> str:
    """The vocabulary file as text, read once on the driver and then broadcast (about 2 MB)."""
    with open(path or public_tokenizers.path(DEFAULT_VOCABULARY), encoding="utf-8") as file:
        return file.read()


@lru_cache(maxsize=4)
def parsed(source: str) -> Vocabulary:
    """Parsed once in each Python worker."""
    return Vocabulary(source)
