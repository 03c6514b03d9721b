"""Words of many texts at once, as 64-bit hashes in numpy.

A class of words is given by the bytes that belong to words. All classes here are
unions of ASCII bytes and of whatever is not ASCII, so UTF-8 bytes can be classed one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: every byte but ASCII white space
VISIBLE = np.ones(256, bool)
VISIBLE[[0x20, *range(0x09, 0x0E)]] = False

#: ASCII letters and digits, and all that is not ASCII
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_ODD = 0x9E3779B97F4A7C15
_PLACE = 0xD1B54A32D192ED03
#: places of a word for which the mixed values lie in a table
_TABLED = 64


@dataclass
class Words:
    """Words of consecutive texts: where each begins and ends in the bytes, and its hash.

    ``first`` has the number of the first word of each text, and of one past the last.
    """

    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    """A fixed random number for each byte, the same for A-Z as for a-z."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
    values[65:91] = values[97:123]
    return values


def _at_places(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A mixed value for each byte and its place in its word."""
    return mixed(_byte_values()[data] ^ (place.astype(np.uint64) * np.uint64(_PLACE)))


@lru_cache(maxsize=1)
def _near_places() -> np.ndarray:
    return _at_places(np.tile(np.arange(256), _TABLED), np.repeat(np.arange(_TABLED), 256))


def words(data: np.ndarray, begin: np.ndarray, members: np.ndarray) -> Words:
    """Words of texts of which the k-th is ``data[begin[k]:begin[k + 1]]``, hashed without case.

    The hash of a word is the sum of a mixed value for each byte and its place in the word, taken
    from running sums; so words collide by chance alone, with odds of about 1 in 2**64.
    """
    n, texts = len(data), len(begin) - 1
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = members[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = begin[:-1][begin[:-1] < begin[1:]]  # first bytes of texts that have any
    starts[edges] = inside[1:-1][edges]
    before = edges[edges > 0] - 1
    ends[before] = inside[1:-1][before]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    origin = np.zeros(n, np.int64)
    origin[starts] = starts
    place = np.arange(n) - np.maximum.accumulate(origin)
    values = _near_places()[(place & (_TABLED - 1)) << 8 | data]
    far = np.flatnonzero(place >= _TABLED)
    values[far] = _at_places(data[far], place[far])
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    hashes = sums[ends] - sums[starts]
    return Words(starts, ends, mixed(hashes), np.searchsorted(starts, begin))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive words, in one value per first word."""
    count = max(0, len(hashes) - length + 1)
    value = np.zeros(count, np.uint64)
    for k in range(length):
        value = value * np.uint64(_ODD) + hashes[k:k + count]
    return mixed(value)
