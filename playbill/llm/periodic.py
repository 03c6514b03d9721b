"""Periodic runs of words: an online dynamic program over sparse diagonals.

A run is a stretch of consecutive words that are equal ``q`` apart, for its smallest such
``q``, at least ``least`` and twice ``q`` long, that no neighbouring word extends. On the
diagonal of lag ``q`` it is a row of matches without a gap. Words are taken in order: the earlier
occurrences of each one lengthen the matches of their lags, and a lag that is not met
again ends; if its matches suffice, the run is emitted at once.

Only lags that can still make a run become active: one of ``q`` needs ``max(q, least - q)``
matches in a row. So lags are taken in classes, from ``w`` to ``4 w``, and an occurrence counts if
``w`` words in a row agree; the runs of words that agree are named exactly, by doubling. Inside a run
of a lower class, occurrences in that run are left out: ``w`` words determine the place in its
period, so their lags are multiples of it. Words are taken in blocks of bounded pairs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from playbill.llm.arrow import slices
from playbill.llm.words import mixed
from playbill.llm.words import runs as run_hashes

#: pairs of a position and a lag that are held at once
PAIRS = 1 << 20
#: how far the lags of a class reach, as a multiple of the words in a row it asks for
SPREAD = 4


def _renamed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both are equal."""
    return np.unique(first * (second.max(initial=0) + 1) + second, return_inverse=True)[1]


def _named(names: np.ndarray, have: int, want: int) -> np.ndarray:
    """From numbers of all runs of ``have`` words, those of all runs of ``want``."""
    while have < want:
        step = min(have, want - have)
        names = _renamed(names[:-step], names[step:])
        have += step
    return names


class _Occurrences:
    """Sorted occurrences of each name, and how many of them lie before a position."""

    def __init__(self, names: np.ndarray):
        self.names, self.width = names, len(names) + 1
        self.keys = np.sort(names * self.width + np.arange(len(names)))

    def before(self, i: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Index, among all occurrences, of the first one of i's name at ``position`` or later."""
        at = np.clip(position, 0, self.width - 1)
        return np.searchsorted(self.keys, self.names[i] * self.width + at)

    def pairs(self, i: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """Each i with its occurrences numbered from begin to end: positions and lags."""
        n = np.maximum(end - begin, 0)
        i, last = np.repeat(i, n), np.cumsum(n)
        at = np.arange(len(i)) - np.repeat(last - n - begin, n)
        return i, i - self.keys[at] % self.width


def _run_starts(n: int, words: int, known: np.ndarray) -> np.ndarray:
    """The least start of the runs that hold ``words`` words from each position; none: n."""
    result = np.full(n, n)
    long = known[known[:, 1] >= words]
    for start, length, _ in long[np.argsort(-long[:, 0], kind="stable")]:
        result[start:start + length - words + 1] = start
    return result


def _diagonals(
    names: np.ndarray, words: int, low: int, high: int, least: int, known: np.ndarray
) -> Iterator[np.ndarray]:
    """Rows (start, length, period) of the stretches on lags from ``low`` to before ``high``.

    ``names`` numbers the run of ``words`` words from each position; ``known`` are runs with
    periods below ``low``, and below ``words``.
    """
    n, all_of = len(names), _Occurrences(names)
    positions = np.arange(n)
    begin = all_of.before(positions, positions - high + 1)
    past = np.minimum(positions - low + 1, _run_starts(n, words, known))
    end = np.maximum(begin, all_of.before(positions, past))
    sums = np.concatenate([[0], np.cumsum(end - begin)])
    lag, start = np.zeros(0, np.int64), np.zeros(0, np.int64)  # active, by lag
    b = 0

    def emitted(lag: np.ndarray, start: np.ndarray, last: np.ndarray) -> np.ndarray:
        length = last + words - start + lag
        good = (length >= 2 * lag) & (length >= least)
        return np.stack([(start - lag)[good], length[good], lag[good]], axis=1)

    while b < n:
        if not len(lag):  # nothing is active: go on where a word has occurred before
            b = int(np.searchsorted(sums, sums[b], "right")) - 1
            if b >= n:
                return
        e = int(np.clip(np.searchsorted(sums, sums[b] + PAIRS, "right") - 1, b + 1, n))
        i = np.arange(b, e)
        at, by = all_of.pairs(i, begin[i], end[i])
        order = np.argsort(by * n + at)
        at, by = at[order], by[order]
        first = np.ones(len(at), bool)
        first[1:] = (by[1:] != by[:-1]) | (at[1:] != at[:-1] + 1)
        heads = np.flatnonzero(first)
        tails = np.append(heads[1:], len(at)) - 1 if len(heads) else heads
        new_lag, new_start, last = by[heads], at[heads].copy(), at[tails]
        # matches that an active lag goes on with
        place = np.searchsorted(lag, new_lag)
        known = (new_start == b) & (place < len(lag))
        known[known] = lag[place[known]] == new_lag[known]
        new_start[known] = start[place[known]]
        over = np.ones(len(lag), bool)
        over[place[known]] = False
        yield emitted(lag[over], start[over], np.full(int(over.sum()), b - 1))
        open_ = last == e - 1
        yield emitted(new_lag[~open_], new_start[~open_], last[~open_])
        lag, start, b = new_lag[open_], new_start[open_], e
    yield emitted(lag, start, np.full(len(lag), n - 1))


def runs_of(words: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence of numbers, by start, then period."""
    n, have, low = len(words), 1, 1
    names = np.unique(words, return_inverse=True)[1].astype(np.int64)
    want = max(1, (least + 1) // 2)
    found = [np.zeros((0, 3), np.int64)]
    while low <= n // 2 and want <= n:
        names, have = _named(names, have, want), want
        if len(names) < 2 or names.max() + 1 == len(names):
            break  # nothing that long occurs again
        high = min(SPREAD * want, n // 2 + 1)
        found += _diagonals(names, want, low, high, least, np.concatenate(found))
        low = want = SPREAD * want
    rows = np.concatenate(found)
    # of the same stretch on several lags, all multiples of the smallest, that one is its period
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(n: int, rows: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run contains after its first ``period`` ones."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def _may_repeat(ids: np.ndarray, first: np.ndarray, words: int) -> np.ndarray:
    """Which texts may have a run of ``words`` words twice, by hashes; the others have not."""
    grams = run_hashes(mixed(ids.astype(np.uint64)), words)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:len(grams)]
    inside = np.arange(len(grams)) + words <= first[text + 1]
    grams, text = grams[inside], text[inside]
    keys = mixed(grams ^ mixed(text.astype(np.uint64)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    result = np.zeros(len(first) - 1, bool)
    result[text[order[1:][same]]] = True
    return result


SCHEMA = ("n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
          "collapsed string")
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def detect(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), least: int = 12) -> DataFrame:
    """The columns ``carry`` of each row of ``docs`` with n_words, runs and collapsed.

    Words are what stands between ASCII white space, told apart byte by byte. ``runs`` has start, length
    and period of every run in words, by start, then period; ``collapsed`` is the text without the
    repetitions, its words joined by one space. A null text counts as empty: no words, no
    runs, an empty collapsed text. Rows are handled one by one, so repeated rows and null
    keys come out as often as they go in; other columns of ``docs`` are not read.
    Memory follows from the longest text; time from the pairs of a word and a lag that
    may make a run, which in a text of long, irregular repeats can be many.
    """
    carry = list(carry)
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    least_words = max(1, (least + 1) // 2)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            numbers = defaultdict(count().__next__)
            texts = [t.encode().split() if t else [] for t in batch.column("text").to_pylist()]
            first = np.cumsum([0, *map(len, texts)])
            ids = np.fromiter((numbers[w] for words in texts for w in words), np.int64, first[-1])
            again = _may_repeat(ids, first, least_words)
            ends, flat, collapsed = [0], [], []
            for k, words in enumerate(texts):
                if again[k]:
                    rows = runs_of(ids[first[k]:first[k + 1]], least)
                    if len(rows):
                        flat.append(rows)
                        words = [words[i] for i in np.flatnonzero(kept_words(len(words), rows))]
                        ends.append(ends[-1] + len(rows))
                        collapsed.append(b" ".join(words))
                        continue
                ends.append(ends[-1])
                collapsed.append(b" ".join(words))
            rows = np.concatenate(flat) if flat else np.zeros((0, 3), np.int64)
            found = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(rows[:, c]) for c in range(3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(np.diff(first), pa.int64()),
                 found.cast(_RUNS), pc.cast(pa.array(collapsed, pa.binary()), pa.string())],
                [*carry, "n_words", "runs", "collapsed"])

    return docs.select(*carry, "text").mapInArrow(run, f"{fields}, {SCHEMA}")
