"""Language identification by spans, learned from labelled documents.

Words are runs of letters. The scripts of a word's letters narrow its languages to those that
use them. Each of these scores the word by its byte trigrams, and the labels of a document's words are the path
of greatest score in which each change of language costs a penalty (Viterbi). The language with
most letters in the path is the document's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.llm.arrow import slices, summed, text_bytes
from playbill.llm.words import words

#: first and last code point of scripts, as Unicode blocks give them (fixed values)
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}

TRIGRAM_BITS = 16
#: score lost where the language changes, in nats
SWITCH = 12.0
#: a language uses a script if it has this share of the letters learned from
SCRIPT_SHARE = 0.01
#: counters per row of what tasks pass on
_BLOCK = 1 << 13
_IMPOSSIBLE = np.float32(-1e6)

LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32

_RANGES = sorted((a, b, k) for k, spans in enumerate(SCRIPTS.values()) for a, b in spans)
_FIRST, _LAST, _SCRIPT = (np.array(x) for x in zip(*_RANGES))


def script_bits(data: np.ndarray) -> np.ndarray:
    """For each byte that begins a character, a bit for its script; 0 elsewhere."""
    bits = np.zeros(len(data), np.uint32)
    bits[LETTERS[data] & (data < 0x80)] = 1 << list(SCRIPTS).index("Latin")
    lead = np.flatnonzero(data >= 0xC0)
    b = data[lead].astype(np.int64)
    padded = np.append(data, [0, 0]).astype(np.int64)
    c1, c2 = padded[lead + 1] & 0x3F, padded[lead + 2] & 0x3F
    point = np.where(b < 0xE0, (b & 0x1F) << 6 | c1, (b & 0x0F) << 12 | c1 << 6 | c2)
    point[b >= 0xF0] = -1
    at = np.searchsorted(_FIRST, point, "right") - 1
    known = (at >= 0) & (point <= _LAST[at])
    bits[lead[known]] = np.uint32(1) << _SCRIPT[at[known]].astype(np.uint32)
    return bits


@dataclass
class Spelled:
    """Words of texts with the trigrams of each: ``gram[i]`` ends at byte i of a word, and
    ``last[w]`` goes past the end of word w."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    gram: np.ndarray
    last: np.ndarray
    scripts: np.ndarray


def _index(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    key = (a << np.uint32(16) | b << np.uint32(8) | c) * np.uint32(0x9E3779B1)
    return key >> np.uint32(32 - TRIGRAM_BITS)


def spelled(data: np.ndarray, begin: np.ndarray) -> Spelled:
    found = words(data, begin, LETTERS)
    low = np.where(LETTERS[data], _LOWER[data], 0).astype(np.uint32)
    before, earlier = np.zeros_like(low), np.zeros_like(low)
    before[1:], earlier[2:] = low[:-1], low[:-2]
    before[found.begin] = 0
    earlier[found.begin] = 0
    second = found.begin[found.end - found.begin > 1] + 1
    earlier[second] = 0
    end = found.end - 1
    last = _index(before[end], low[end], np.zeros(len(end), np.uint32))
    bits = script_bits(data)
    scripts = bits[:0]
    if len(end):
        scripts = np.bitwise_or.reduceat(np.append(bits, np.uint32(0)), _cuts(found))[::2]
    return Spelled(found.begin, found.end, found.first, _index(earlier, before, low), last, scripts)


def _cuts(found) -> np.ndarray:
    """Begin and end of each word in turn, for sums over words alone."""
    cuts = np.empty(2 * len(found.begin), np.int64)
    cuts[::2], cuts[1::2] = found.begin, found.end
    return cuts


@dataclass
class Model:
    """Languages, score of each trigram in each, and the scripts that each uses."""

    languages: list[str]
    score: np.ndarray
    scripts: np.ndarray


def learn(labelled: DataFrame, language: str = "lang") -> Model:
    """A model from the texts and non-null languages of all rows of ``labelled``.

    One pass; each task adds up counts of trigrams and of letters by script for each language. The sums are
    of a fixed size for each language.
    """
    slots = (1 << TRIGRAM_BITS) + len(SCRIPTS)
    slots += -slots % _BLOCK

    def run(batches: Iterator[pa.RecordBatch]):
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            data, begin = text_bytes(batch.column("text"))
            found = spelled(data, begin)
            bits = script_bits(data)
            labels = np.array(batch.column(language).to_pylist(), object)
            size = np.diff(begin)
            inside = LETTERS[data]
            for label in set(labels):
                own = labels == label
                total = totals.setdefault(label, np.zeros(slots, np.int64))
                mine = np.repeat(own, size)
                total[:1 << TRIGRAM_BITS] += np.bincount(
                    found.gram[mine & inside], minlength=1 << TRIGRAM_BITS)
                total[:1 << TRIGRAM_BITS] += np.bincount(
                    found.last[np.repeat(own, np.diff(found.first))], minlength=1 << TRIGRAM_BITS)
                counted = bits[mine]
                for k in range(len(SCRIPTS)):
                    total[(1 << TRIGRAM_BITS) + k] += np.count_nonzero(counted == 1 << k)
        part = TaskContext.get().partitionId()
        for label, total in totals.items():
            for block in range(0, slots, _BLOCK):
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "label": pa.array([label], pa.string()),
                    "block": pa.array([block], pa.int32()),
                    "counts": pa.array([total[block:block + _BLOCK].tobytes()], pa.binary())})

    given = labelled.where(F.col(language).isNotNull() & F.col("text").isNotNull()).select(
        "text", F.col(language).cast("string").alias(language))
    parts = given.mapInArrow(run, "part int, label string, block int, counts binary")
    sums: dict[str, np.ndarray] = {}
    for row in summed(parts, ["label", "block"]).collect():
        total = sums.setdefault(row.label, np.zeros(slots, np.int64))
        total[row.block:row.block + _BLOCK] = np.frombuffer(row.counts, np.int64)
    languages = sorted(sums)
    if not languages:
        return Model([], np.zeros((0, 1 << TRIGRAM_BITS), np.float32), np.zeros(0, np.uint32))
    counts = np.array([sums[x][:1 << TRIGRAM_BITS] for x in languages], np.float64)
    chance = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * (1 << TRIGRAM_BITS))
    letters = np.array([sums[x][1 << TRIGRAM_BITS:][:len(SCRIPTS)] for x in languages], np.float64)
    uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(1, keepdims=True), 1)
    return Model(languages, np.log(chance).astype(np.float32),
                 (uses << np.arange(len(SCRIPTS))).sum(1).astype(np.uint32))


def word_scores(found: Spelled, model: Model) -> np.ndarray:
    """Score of each word (row) in each language; impossible where a script rules it out.

    A word in scripts that no language uses leaves all languages possible.
    """
    n, result = len(found.begin), np.zeros((len(found.begin), len(model.languages)), np.float32)
    if not n:
        return result
    cuts = _cuts(found)
    for k, score in enumerate(model.score):
        result[:, k] = np.add.reduceat(
            np.append(score[found.gram], np.float32(0)), cuts)[::2] + score[found.last]
    ruled_out = (found.scripts[:, None] & ~model.scripts[None, :]) != 0
    ruled_out[ruled_out.all(1)] = False
    result[ruled_out] = _IMPOSSIBLE
    return result


def best_path(scores: np.ndarray, switch: float) -> np.ndarray:
    """Language of each word on the path of greatest score less ``switch`` per change.

    The language of greatest total is the whole path if no run of words would gain more
    than one change costs, were each word free to take any other language: every path away from
    it changes once at least per run. Else the path is found word by word.
    """
    main = int(scores.sum(0, dtype=np.float64).argmax())
    if scores.shape[1] == 1:
        return np.full(len(scores), main)
    others = np.delete(scores, main, 1).max(1) - scores[:, main]
    total = np.concatenate([[0.0], np.cumsum(others.astype(np.float64))])
    if (total - np.minimum.accumulate(total)).max() <= switch:
        return np.full(len(scores), main)
    back = np.empty(scores.shape, np.int64)
    stay = np.arange(scores.shape[1])
    value = scores[0].astype(np.float64)
    for k in range(1, len(scores)):
        best = int(value.argmax())
        jump = value[best] - switch
        moves = value < jump
        back[k] = np.where(moves, best, stay)
        value = np.where(moves, jump, value) + scores[k]
    path = np.empty(len(scores), np.int64)
    path[-1] = value.argmax()
    for k in range(len(scores) - 1, 0, -1):
        path[k - 1] = back[k, path[k]]
    return path


UNDETERMINED = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def labelled_spans(
    column: pa.Array, model: Model, switch: float = SWITCH
) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """Of each text: language, share of its letters, and spans (first byte, past last, language)."""
    data, begin = text_bytes(column)
    found = spelled(data, begin)
    scores = word_scores(found, model)
    ascii_letters = np.concatenate([[0], np.cumsum(LETTERS[data] & (data < 0x80))])[begin]
    plain = np.diff(ascii_letters) > 0
    result = []
    for k in range(len(column)):
        a, b = found.first[k], found.first[k + 1]
        if a == b or not model.languages or not (plain[k] or has_letter(column[k].as_py())):
            result.append((UNDETERMINED, 0.0, []))
            continue
        path = best_path(scores[a:b], switch)
        sizes = found.end[a:b] - found.begin[a:b]
        weight = np.bincount(path, sizes, len(model.languages))
        top = int(weight.argmax())
        edges = np.flatnonzero(np.diff(path)) + 1
        spans = [
            (int(found.begin[a + i] - begin[k]), int(found.end[a + j - 1] - begin[k]),
             model.languages[path[i]])
            for i, j in zip([0, *edges], [*edges, b - a])]
        result.append((model.languages[top], float(weight[top] / weight.sum()), spans))
    return result


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])


def predict(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, spans.

    ``score`` is the share of letters that the path gives to lang_pred. Spans are in bytes of
    the UTF-8 text. A text that is null or has no letter is ``und`` with score 0, as is
    every text if the model has no language. Reads doc_id and text alone; moves no row.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            label, score, spans = zip(*labelled_spans(batch.column("text"), model, switch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(label, pa.string()), pa.array(score, pa.float64()),
                 pa.array([[dict(zip(("begin", "end", "lang"), s)) for s in x] for x in spans],
                          pa.list_(_SPAN))],
                ["doc_id", "lang_pred", "score", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, "
             "spans array<struct<begin:bigint,end:bigint,lang:string>>")


def remainder(divisor: int) -> Column:
    """crc32 of the doc_id as text, by which rows are held out; a null one reads as empty."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor


def keep_known(docs: DataFrame, model: Model, least: float, switch: float = SWITCH) -> DataFrame:
    """The rows of ``docs`` with a determined language that has ``least`` of the letters or more."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            kept = [label != UNDETERMINED and score >= least for label, score, _ in
                    labelled_spans(batch.column("text"), model, switch)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
