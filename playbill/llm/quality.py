"""Quality by a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn, each on one feature, so that what a feature adds is a
lookup table over its bins; then pairs of features that explain most of what is left get tables
in the same way. A document scores by adding up the entries of its bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from playbill.llm.arrow import slices, text_bytes
from playbill.llm.labels import sample
from playbill.llm.words import VISIBLE, mixed, runs, words

FEATURES = (
    "log_words", "word_length", "capitals", "symbols", "digits", "not_ascii", "line_ends",
    "stops", "exclamations", "bars", "distinct_words", "same_as_before", "distinct_triples",
    "distinct_lines", "commonest_word", "symbol_words",
)

#: labelled rows of either label learned from, about, those with the smallest hash
SAMPLE_ROWS = 10_000
BINS = 48
PAIR_BINS = 8
ROUNDS = 150
PAIRS = 8
PAIR_ROUNDS = 60
RATE = 0.1
LEAVES = 4
#: rows a leaf needs, and what keeps its value small
LEAF_ROWS = 10
SHRINKAGE = 2.0

_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_LETTER = _CAPITAL.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = VISIBLE & ~_LETTER & ~_DIGIT
_SYMBOL[0x80:] = False
_STOP = np.zeros(256, bool)
_STOP[[*b".?"]] = True


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; shares of nothing are 0."""
    data, begin = text_bytes(column)
    found = words(data, begin, VISIBLE)
    n = len(begin) - 1
    size = np.maximum(np.diff(begin), 1)
    n_words = np.diff(found.first)
    some = np.maximum(n_words, 1)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return np.diff(total[begin])

    def per_word(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return np.diff(total[found.first])

    text = np.repeat(np.arange(n), n_words)
    again = np.zeros(len(found.hash), bool)
    again[1:] = (found.hash[1:] == found.hash[:-1]) & (text[1:] == text[:-1])
    distinct, commonest = _distinct(found.hash, text, n)
    triples = runs(found.hash, 3)
    whole = text[:len(triples)] == text[2:] if len(triples) else np.zeros(0, bool)
    inside = text[:len(triples)][whole]
    n_triples = np.bincount(inside, minlength=n)
    lines = words(data, begin, _LINE)
    line_text = np.repeat(np.arange(n), np.diff(lines.first))
    n_lines = np.diff(lines.first)
    last = data[found.end - 1] if len(found.end) else data[:0]
    before = data[np.maximum(found.end - 2, 0)] if len(found.end) else data[:0]
    tail = _SYMBOL[last] & _SYMBOL[before] & (found.end - found.begin > 1)
    letters = np.maximum(count(_LETTER[data]), 1)
    return np.column_stack([
        np.log1p(n_words),
        count(VISIBLE[data]) / some,
        count(_CAPITAL[data]) / letters,
        count(_SYMBOL[data]) / size,
        count(_DIGIT[data]) / size,
        count(data >= 0x80) / size,
        count(data == 0x0A) / some,
        count(_STOP[data]) / some,
        count(data == ord("!")) / some,
        count(data == ord("|")) / some,
        distinct / some,
        per_word(again) / some,
        _distinct(triples[whole], inside, n)[0] / np.maximum(n_triples, 1),
        _distinct(lines.hash, line_text, n)[0] / np.maximum(n_lines, 1),
        commonest / some,
        per_word(tail) / some,
    ]).astype(np.float64)


_LINE = np.ones(256, bool)
_LINE[[0x0A, 0x0D]] = False


def _distinct(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different values of each text, and how often its commonest one occurs."""
    both = mixed(hashes ^ mixed(text.astype(np.uint64) + np.uint64(1)))
    _, first, times = np.unique(both, return_index=True, return_counts=True)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, text[first], times)
    return np.bincount(text[first], minlength=n), most


@dataclass
class Model:
    """Bin edges and a table per feature; edges and tables of pairs; what all start from."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, k], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[i], x[:, i], "right"),
                           np.searchsorted(self.pair_edges[j], x[:, j], "right")]
        return _logistic(total)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between bins of about as many rows; no two alike."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINKAGE)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Values of the bins under a tree of at most LEAVES leaves over sums of its bins."""
    leaves, values = [(0, len(g))], np.zeros(len(g))
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (g, h, n)]
    while len(leaves) < LEAVES:
        best = (1e-9, None, None)
        for a, b in leaves:
            cut = np.arange(a + 1, b)
            if not len(cut):
                continue
            (gl, hl, nl), (gr, hr, nr) = zip(*((s[cut] - s[a], s[b] - s[cut]) for s in sums))
            better = _gain(gl, hl) + _gain(gr, hr) - _gain(gl + gr, hl + hr)
            better[(nl < LEAF_ROWS) | (nr < LEAF_ROWS)] = 0
            k = int(better.argmax())
            if better[k] > best[0]:
                best = (better[k], (a, b), int(cut[k]))
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    for a, b in leaves:
        values[a:b] = -g[a:b].sum() / (h[a:b].sum() + SHRINKAGE)
    return values


def _corner_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of a grid of bins into four corners."""
    values, best = np.zeros(g.shape), 0.0
    whole = _gain(g.sum(), h.sum())
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            corners = [(slice(None, a), slice(None, b)), (slice(None, a), slice(b, None)),
                       (slice(a, None), slice(None, b)), (slice(a, None), slice(b, None))]
            gain = sum(_gain(g[c].sum(), h[c].sum()) for c in corners) - whole
            if gain > best:
                best, values = gain, np.zeros(g.shape)
                for c in corners:
                    values[c] = -g[c].sum() / (h[c].sum() + SHRINKAGE)
    return best, values


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Tables of all features, then of the pairs that gain most, each boosted in turn."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    edges = [_edges(x[:, k], BINS) for k in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), start)
    for _ in range(ROUNDS):
        for k, own in enumerate(bins):
            p = _logistic(total)
            size = len(tables[k])
            step = RATE * _tree(np.bincount(own, p - y, size), np.bincount(own, p * (1 - p), size),
                                np.bincount(own, minlength=size))
            tables[k] += step
            total += step[own]
    pair_edges = [_edges(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    pair_bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(pair_edges)]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)
        cell = pair_bins[i] * shape[1] + pair_bins[j]
        p = _logistic(total)
        return (cell, *(np.bincount(cell, w, shape[0] * shape[1]).reshape(shape)
                        for w in (p - y, p * (1 - p))))

    gains = sorted(
        ((_corner_tree(*grid(i, j)[1:])[0], i, j)
         for i in range(x.shape[1]) for j in range(i + 1, x.shape[1])), reverse=True)
    pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    pair_tables = [np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(pairs):
            cell, g, h = grid(i, j)
            step = RATE * _corner_tree(g, h)[1]
            pair_tables[k] += step
            total += step.ravel()[cell]
    return Model(edges, tables, pair_edges, pairs, pair_tables, start)


def described(rows: DataFrame) -> DataFrame:
    """doc_id, quality and FEATURES of labelled rows."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), *map(pa.array, features(batch.column("text")).T.copy())],
                ["quality", *FEATURES])

    return rows.select("quality", "text").mapInArrow(
        run, ", ".join(["quality bigint", *(f"{f} double" for f in FEATURES)]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1).

    At most about ``rows`` rows of each label are used. The driver gets their features, a
    bounded number of bytes, and never a text. Without rows all score alike.
    """
    found, odds = sample(docs, labels, "quality", rows)
    learned = described(found).toPandas()
    if learned.empty:
        return Model([], [], [], [], [], 0.0)
    # an order of its own, so that sums do not depend on which task came first
    learned = learned.sort_values([*FEATURES, "quality"])
    model = train(learned[list(FEATURES)].to_numpy(), learned.quality.to_numpy().astype(float))
    model.start -= odds
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1).

    Null and empty texts score by features that are all 0. Reads doc_id and text alone
    and moves no row.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "score": pa.array(model.scores(features(batch.column("text"))))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
