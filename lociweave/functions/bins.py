"""The binning scheme of genome indexes: six levels of bins over 512 Mb, the smallest of 16 kb.

All intervals are 0-based and half-open.
"""

import numpy as np

SMALLEST_SHIFT, LEVELS, LEVEL_BITS = 14, 5, 3
LIMIT = 1 << (SMALLEST_SHIFT + LEVELS * LEVEL_BITS)
# Fixed value: the pseudo-bin in which an index keeps the extent and the number of records of a contig.
COUNT_BIN = 37450


def level_start(level: int) -> int:
    """The number of the first bin of a level; level 0 is the one bin over everything."""
    return ((1 << LEVEL_BITS * level) - 1) // ((1 << LEVEL_BITS) - 1)


def level_shift(level: int) -> int:
    return SMALLEST_SHIFT + LEVEL_BITS * (LEVELS - level)


def bin_of(begin: int, end: int) -> int:
    """The smallest bin that holds an interval."""
    last = max(end - 1, begin)
    if last >= LIMIT:
        raise ValueError(f"position {last + 1} is beyond the {LIMIT} that an index can hold")
    for level in reversed(range(LEVELS + 1)):
        shift = level_shift(level)
        if begin >> shift == last >> shift:
            return level_start(level) + (begin >> shift)
    raise AssertionError("the whole range is one bin")


def bins_of(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``bin_of`` for many intervals."""
    lasts = np.maximum(ends - 1, begins)
    if len(lasts) and lasts.max() >= LIMIT:
        i = int(np.argmax(lasts >= LIMIT))
        bin_of(int(begins[i]), int(ends[i]))  # fails
    numbers = np.zeros_like(begins)
    for level in range(LEVELS + 1):
        shift = level_shift(level)
        numbers = np.where(begins >> shift == lasts >> shift, level_start(level) + (begins >> shift), numbers)
    return numbers


def bins_over(begin: int, end: int) -> list[range]:
    """The bins that may hold records of an interval, a range for each level."""
    last = min(max(end - 1, begin), LIMIT - 1)
    found = []
    for level in range(LEVELS + 1):
        first, shift = level_start(level), level_shift(level)
        found.append(range(first + (begin >> shift), first + (last >> shift) + 1))
    return found
