"""Repeated long strings, found by suffix sorting of bounded blocks and cut out of the texts.

Every string of ``LENGTH`` bytes holds an anchor, the least-hashed of its runs of ``RUN`` bytes, which equal strings
share with its place. So each text falls into segments, the windows of one anchor each, and
only segments whose anchor occurs elsewhere can hold repeats. Of these, segments alike count once, and the
rest are gathered by anchor into blocks. In a block suffixes are sorted in two stages:
those smaller than their successor are sorted directly, all others are induced by one
scan over the buckets of first bytes; a window is repeated where its common prefix with a neighbour is as
long as the window.
"""

from __future__ import annotations

import numpy as np

LENGTH = 400
RUN = 128

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = 31


def run_hashes(data: np.ndarray, run: int) -> np.ndarray:
    """A hash of each run of ``run`` bytes, by doubling; the last ones go past the end."""
    n = len(data)
    x = data.astype(np.uint64) + np.uint64(1)
    x *= _ODD
    x ^= x >> np.uint64(29)
    result, done, width = None, 0, 1
    while True:
        if run & width:
            if result is None:
                result = x.copy()
            else:
                result[:max(n - done, 0)] += x[done:] * _odd_power(done)
            done += width
        width *= 2
        if width > run:
            break
        y = x.copy()
        y[:max(n - width // 2, 0)] += x[width // 2:] * _odd_power(width)
        y ^= y >> np.uint64(31)
        y *= _ODD
        x = y
    result ^= result >> np.uint64(32)
    result *= np.uint64(0xD1342543DE82EF95)
    return result ^ (result >> np.uint64(29))


def _odd_power(width: int) -> np.uint64:
    return np.uint64(pow(0xBF58476D1CE4E5B9, 2 * width + 1, 1 << 64))


def segments(
    data: np.ndarray, begin: np.ndarray, length: int, run: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts of which the k-th is ``data[begin[k]:begin[k + 1]]``: first and last window start of each
    segment, and its anchor's hash and place in the bytes.

    Windows lie within one text; their anchor is the leftmost of the runs of least hash in them.
    """
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty.astype(np.uint64), empty
    hashes = run_hashes(data, run)
    places = np.arange(n, dtype=np.uint64)
    least = (hashes & ~np.uint64((1 << _PLACE_BITS) - 1)) | places
    reach, width = length - run + 1, 1
    while 2 * width <= reach:
        least[:n - width] = np.minimum(least[:n - width], least[width:])
        width *= 2
    if reach > width:
        rest = reach - width
        least[:n - rest] = np.minimum(least[:n - rest], least[rest:])
    anchor = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    size = np.diff(begin)
    valid = np.zeros(n + 1, np.int8)
    long = size >= length
    np.add.at(valid, begin[:-1][long], 1)
    np.add.at(valid, begin[1:][long] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(starts):
        return empty, empty, empty.astype(np.uint64), empty
    own = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], starts[last], hashes[own[first]], own[first]


def suffix_order(text: bytes, depth: int) -> np.ndarray:
    """All suffixes of ``text`` in the order of their first ``depth`` bytes, sorted in two stages."""
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    # smaller than its successor: by the first byte that differs from the next
    change = np.flatnonzero(data[:-1] != data[1:])
    at = np.searchsorted(change, np.arange(n))
    rises = np.zeros(n, bool)
    inner = at < len(change)
    rises[inner] = data[change[at[inner]]] < data[change[at[inner]] + 1]
    # in the last run of alike bytes a shorter suffix comes first: none but the end is direct
    rises[n - 1] = True
    direct = np.flatnonzero(rises)
    by_byte = direct[np.argsort(data[direct], kind="stable")]
    bounds = np.searchsorted(data[by_byte], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    result = []
    for c in range(256):
        found = induced[c]
        current = np.concatenate(found) if found else np.zeros(0, np.int64)
        falling = [current]
        end = np.zeros(0, np.int64)
        if data[n - 1] == c:
            end = np.array([n - 1])
            falling.insert(0, end)
            current = np.concatenate([end, current])
        while len(current):
            before = current - 1
            before = before[before >= 0]
            current = before[(data[before] == c) & ~rises[before]]
            falling.append(current)
        own = by_byte[bounds[c]:bounds[c + 1]]
        rising = sorted(own[own != n - 1].tolist(), key=lambda i: text[i:i + depth])
        bucket = np.concatenate([*falling, np.array(rising, np.int64)])
        result.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[data[before] > c]
        if len(before):
            order = np.argsort(data[before], kind="stable")
            before = before[order]
            symbols, first = np.unique(data[before], return_index=True)
            for symbol, a, b in zip(symbols, first, np.append(first[1:], len(before))):
                induced[symbol].append(before[a:b])
    return np.concatenate(result)


def common_prefixes(text: bytes, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each pair of suffixes, as far as ``most``."""
    data = np.frombuffer(text + bytes(most + 8), np.uint8)
    eights = np.ndarray((len(data) - 8,), "<u8", data, strides=(1,))
    length = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    for done in range(0, most, 8):
        differ = eights[a[active] + done] ^ eights[b[active] + done]
        stop = differ != 0
        low = differ[stop]
        # bytes before the lowest that differs
        low &= ~low + np.uint64(1)
        length[active[stop]] = done + (np.log2(low.astype(np.float64)) // 8).astype(np.int64)
        active = active[~stop]
        if not len(active):
            break
    length[active] = most
    return np.minimum(length, most)


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """Of each part, which of its windows of ``length`` bytes start elsewhere in the parts too."""
    text = b"\0".join(parts)
    order = suffix_order(text, length)
    sizes = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    count = np.maximum(sizes - length + 1, 0)
    is_window = np.zeros(len(text) + 1, np.int64)
    np.add.at(is_window, begin, count > 0)
    np.add.at(is_window, begin + count, -(count > 0).astype(np.int64))
    is_window = np.cumsum(is_window).astype(bool)
    order = order[is_window[order]]
    again = np.zeros(len(text), bool)
    if len(order) > 1:
        same = common_prefixes(text, order[:-1], order[1:], length) >= length
        again[order[:-1][same]] = True
        again[order[1:][same]] = True
    return [again[b:b + c] for b, c in zip(begin, count)]
