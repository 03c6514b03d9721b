"""Benchmark passages in documents, by a prefix-filtered set join.

A window is a run of ``WINDOW`` words of a benchmark item, or the whole of a shorter item. Its set is
its shingles of ``SHINGLE`` words with their places. A window occurs in a document only if all of
its set does, in order and without gaps; for an overlap of the whole set the necessary
prefix under any order is one token. Shingles are ordered by how often documents have
them, so each window joins by its rarest shingle. Of the shingles of a document that meet a
prefix, those stay for which the window fits between the ends of the text (the bound on
length and place); then all of its words are compared, as text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.llm.arrow import slices, text_bytes
from playbill.llm.words import ALPHANUMERIC, Words, runs, words

WINDOW = 13
SHINGLE = 4
#: benchmark rows joined at once, by bytes of their texts: bounds what a task is sent
BLOCK_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Item:
    """One benchmark row: its identifier as text and its words."""

    name: str
    words: list[bytes]


@dataclass
class Windows:
    """Distinct windows of a block of items, by their lengths.

    For each length: the joined words, the items that have them, and the hash, place and
    width of each shingle of each window.
    """

    texts: list[bytes]
    length: np.ndarray
    items: list[tuple[int, ...]]
    names: list[str]


def item_words(text: str | None) -> list[bytes]:
    data = _LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    found = words(data, np.array([0, len(data)]), ALPHANUMERIC)
    raw = data.tobytes()
    return [raw[b:e] for b, e in zip(found.begin, found.end)]


def windows_of(items: list[Item], window: int) -> Windows:
    """The windows of the items; one that several items share comes once."""
    having: dict[tuple[bytes, ...], set[int]] = {}
    for number, item in enumerate(items):
        size = min(window, len(item.words))
        for k in range(len(item.words) - size + 1 if size else 0):
            having.setdefault(tuple(item.words[k:k + size]), set()).add(number)
    return Windows(
        [b" ".join(w) for w in having], np.array([len(w) for w in having], np.int64),
        [tuple(sorted(s)) for s in having.values()], [i.name for i in items])


@dataclass
class Shingles:
    """Shingles of windows: hash, window, place in it, and words per shingle."""

    hash: np.ndarray
    window: np.ndarray
    place: np.ndarray
    width: np.ndarray


def shingles_of(windows: Windows, shingle: int) -> Shingles:
    """All shingles of all windows; a window of fewer words is one shingle."""
    data = np.frombuffer(b"\n".join(windows.texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in windows.texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    begin[-1] -= 1 if len(sizes) else 0
    found = words(data, begin, ALPHANUMERIC)
    parts = []
    for width in range(1, shingle + 1):
        own = (windows.length >= shingle) if width == shingle else windows.length == width
        hashes = runs(found.hash, width)
        for w in np.flatnonzero(own):
            places = np.arange(windows.length[w] - width + 1)
            parts.append((hashes[found.first[w] + places], np.full(len(places), w), places,
                          np.full(len(places), width)))
    if not parts:
        empty = np.zeros(0, np.int64)
        return Shingles(empty.astype(np.uint64), empty, empty, empty)
    return Shingles(*(np.concatenate(p) for p in zip(*parts)))


def _document_shingles(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the shingles of all texts; none crosses two of them."""
    hashes = runs(found.hash, width)
    at = np.arange(len(hashes))
    text = np.searchsorted(found.first, at, "right") - 1
    whole = at + width <= found.first[text + 1]
    return at[whole], hashes[whole]


def frequencies(docs: DataFrame, shingles: Shingles) -> np.ndarray:
    """How often each shingle occurs in all documents, as far as hashes tell.

    One pass; each task adds up its counts, and the sums are one row per shingle at most.
    """
    tables = {int(w): np.unique(shingles.hash[shingles.width == w]) for w in set(shingles.width)}

    def run(batches: Iterator[pa.RecordBatch]):
        total = {w: np.zeros(len(t), np.int64) for w, t in tables.items()}
        for batch in slices(batches, "text"):
            found = words(*text_bytes(batch.column("text")), ALPHANUMERIC)
            for w, table in tables.items():
                _, hashes = _document_shingles(found, w)
                at = _positions(table, hashes)
                total[w] += np.bincount(at[at >= 0], minlength=len(table))
        for w, table in tables.items():
            seen = total[w] > 0
            yield pa.RecordBatch.from_pydict({
                "width": pa.array(np.full(seen.sum(), w), pa.int32()),
                "hash": pa.array(table[seen].view(np.int64)), "n": pa.array(total[w][seen])})

    counted = (docs.select("text").mapInArrow(run, "width int, hash bigint, n bigint")
               .groupBy("width", "hash").agg(F.sum("n").alias("n")).toArrow())
    result = np.zeros(len(shingles.hash), np.int64)
    for w, table in tables.items():
        mine = counted.filter(pc.equal(counted["width"], w))
        n = np.zeros(len(table), np.int64)
        n[np.searchsorted(table, mine["hash"].to_numpy().view(np.uint64))] = mine["n"].to_numpy()
        own = shingles.width == w
        result[own] = n[np.searchsorted(table, shingles.hash[own])]
    return result


def _positions(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where each value stands in the sorted table, or -1."""
    if not len(table):
        return np.full(len(values), -1)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return np.where(table[at] == values, at, -1)


@dataclass
class Prefixes:
    """One shingle per window, the rarest: sorted by hash within each width."""

    width: int
    hash: np.ndarray
    window: np.ndarray
    place: np.ndarray


def prefixes(shingles: Shingles, count: np.ndarray) -> list[Prefixes]:
    """The necessary prefix of each window, which for whole containment is one shingle."""
    order = np.lexsort((shingles.hash, count, shingles.window))
    rarest = order[np.unique(shingles.window[order], return_index=True)[1]]
    # a rarest shingle that no document has proves that the window occurs in none
    rarest = rarest[count[rarest] > 0]
    result = []
    for width in sorted(set(shingles.width[rarest])):
        own = rarest[shingles.width[rarest] == width]
        own = own[np.argsort(shingles.hash[own], kind="stable")]
        result.append(Prefixes(
            int(width), shingles.hash[own], shingles.window[own], shingles.place[own]))
    return result


def occurrences(
    found: Words, raw: bytes, windows: Windows, index: list[Prefixes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word (counted over all texts) and window of each occurrence."""
    texts, begins, which = [], [], []
    for p in index:
        at, hashes = _document_shingles(found, p.width)
        low = np.searchsorted(p.hash, hashes)
        high = np.searchsorted(p.hash, hashes, "right")
        met = np.flatnonzero(high > low)
        for m in met:
            for k in range(low[m], high[m]):
                w = p.window[k]
                first = at[m] - p.place[k]
                text = np.searchsorted(found.first, at[m], "right") - 1
                last = first + windows.length[w] - 1
                if first < found.first[text] or last >= found.first[text + 1]:
                    continue
                spelled = b" ".join(
                    raw[found.begin[i]:found.end[i]] for i in range(first, last + 1))
                if spelled == windows.texts[w]:
                    texts.append(text)
                    begins.append(first)
                    which.append(w)
    return (np.array(texts, np.int64), np.array(begins, np.int64), np.array(which, np.int64))


@dataclass
class Verdicts:
    """Per text: words, the hit ones as runs (first, past last), names of its items."""

    n_words: np.ndarray
    spans: list[list[tuple[int, int]]]
    items: list[list[str]]


def judged(column: pa.Array, windows: Windows, index: list[Prefixes]) -> Verdicts:
    """Where windows occur in each text of an Arrow column."""
    data, begin = text_bytes(column)
    found = words(data, begin, ALPHANUMERIC)
    n = len(begin) - 1
    spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    items: list[set[int]] = [set() for _ in range(n)]
    if index:
        raw = _LOWER[data].tobytes()
        texts, first, which = occurrences(found, raw, windows, index)
        for k in np.lexsort((first, texts)):
            text, at = int(texts[k]), int(first[k] - found.first[texts[k]])
            end = at + int(windows.length[which[k]])
            if spans[text] and at <= spans[text][-1][1]:
                spans[text][-1] = (spans[text][-1][0], max(end, spans[text][-1][1]))
            else:
                spans[text].append((at, end))
            items[text].update(windows.items[which[k]])
    return Verdicts(np.diff(found.first), spans, [sorted({windows.names[i] for i in s}) for s in items])


def load_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[Item]]:
    """The benchmark's items in blocks of about ``block_bytes``, read one at a time.

    Items without words, null texts included, have no windows and are left out. A null
    item_id reads as the empty name.
    """
    block, size = [], 0
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    for row in rows.orderBy("item_id").toLocalIterator():
        item = Item(row.item_id, item_words(row.text))
        if not item.words:
            continue
        block.append(item)
        size += len(row.text)
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def plan(
    docs: DataFrame, items: list[Item], window: int = WINDOW, shingle: int = SHINGLE
) -> tuple[Windows, list[Prefixes]]:
    """The windows of a block and the prefix by which each is joined to ``docs``."""
    windows = windows_of(items, window)
    shingles = shingles_of(windows, shingle)
    return windows, prefixes(shingles, frequencies(docs, shingles))

_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_MARK = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)),
                   ("items", pa.list_(pa.string()))])
_MARK_DDL = "struct<n_words:bigint,spans:array<struct<begin:bigint,end:bigint>>,items:array<string>>"


def _joined(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Two lists of runs as one, without overlaps."""
    result: list[tuple[int, int]] = []
    for begin, end in sorted([*a, *b]):
        if result and begin <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((begin, end))
    return result


def _mark_block(
    docs: DataFrame, items: list[Item], mark: str, keep: list[str], window: int, shingle: int
) -> DataFrame:
    windows, index = plan(docs, items, window, shingle)
    earlier = mark in docs.columns

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            found = judged(batch.column("text"), windows, index)
            rows = [
                {"n_words": int(n), "spans": s, "items": i}
                for n, s, i in zip(found.n_words, found.spans, found.items)]
            if earlier:
                for row, old in zip(rows, batch.column(mark).to_pylist()):
                    old_spans = [(s["begin"], s["end"]) for s in old["spans"]]
                    row["spans"] = _joined(old_spans, row["spans"])
                    row["items"] = sorted({*old["items"], *row["items"]})
            for row in rows:
                row["spans"] = [{"begin": b, "end": e} for b, e in row["spans"]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(rows, _MARK)], [*keep, mark])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.mapInArrow(run, ", ".join([*fields, f"`{mark}` {_MARK_DDL}"]))


def marked(
    docs: DataFrame, benchmark: DataFrame, work: str, keep: list[str] | None = None,
    mark: str = "decontamination", window: int = WINDOW, shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all unless named) and a column ``mark``: n_words, the
    hit words as runs (first, past last), and the item_ids of windows that occur.

    Each block of the benchmark is one pass that moves no document; from the second block on, the
    marked documents are stored under ``work`` before the next, so the driver and the tasks
    hold one block at a time. Null texts have no words; items that are alike share their
    windows; without items nothing is hit. ``mark`` must not name a column of ``docs``.
    """
    keep = docs.columns if keep is None else keep
    if mark.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the frame already has a column {mark}")
    blocks = load_blocks(benchmark, block_bytes)
    block, number = next(blocks, []), 0
    while (following := next(blocks, None)) is not None:
        path = f"{work}/block-{number}"
        _mark_block(docs, block, mark, [c for c in docs.columns if c != mark], window, shingle
                    ).write.parquet(path)
        docs, block, number = docs.sparkSession.read.parquet(path), following, number + 1
    return _mark_block(docs, block, mark, keep, window, shingle)


def _hits(mark: str) -> Column:
    return F.aggregate(
        f"{mark}.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])


def _contaminated(mark: str) -> Column:
    """Hits, and for a twentieth of the words or more."""
    return (_hits(mark) > 0) & (20 * _hits(mark) >= F.col(f"{mark}.n_words"))


def findings(docs: DataFrame, benchmark: DataFrame, work: str, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items, spans, contaminated."""
    found = marked(docs.select("doc_id", "text"), benchmark, work, ["doc_id"], "_mark", **options)
    return found.select(
        "doc_id", "_mark.n_words", _hits("_mark").alias("n_hit"),
        F.size("_mark.items").cast("bigint").alias("n_items"), "_mark.items", "_mark.spans",
        _contaminated("_mark").alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, work: str, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    mark = "_mark"
    while mark in (c.lower() for c in docs.columns):
        mark = f"_{mark}"
    found = marked(docs, benchmark, work, None, mark, **options)
    return found.where(~_contaminated(mark)).select(*docs.columns)
