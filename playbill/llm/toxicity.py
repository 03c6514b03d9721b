"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel counts common subsequences of ORDER characters, each weighted down by the stretch of text
it takes, so letters put into a word or left out of it only lower it. A sentence is described by
its words' greatest likeness to each of a few landmark words. Sentences are labelled by their
documents: of a toxic document one sentence at least is toxic, of any other none is. So training
alternates between fitting the machine to the worst sentence of each labelled document and choosing the
worst sentences anew by the machine. In the first rounds landmarks are added to it: words of the
labelled documents along which its loss falls fastest. A document's score follows from its sentences'
margins, the worst one and how much the others add to it, through a curve drawn over
documents that were not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.arrow import slices, text_bytes
from playbill.llm.labels import sample
from playbill.llm.words import VISIBLE, mixed, words

ORDER = 3
DECAY = 0.7
#: bytes of a word seen at once; a longer word is seen in windows that overlap by half
WIDTH = 24
SHARPNESS = 3
#: landmarks, and how many are added in a round
LANDMARKS, ADDED = 24, 8
#: words among which those to add are sought, and the greatest likeness that they may have
POOL, MOST_ALIKE = 400, 0.3
#: landmarks are whole words of at most so many bytes
LANDMARK_WIDTH = 12
#: labelled rows learned from at most, of either label, those with the smallest hash
SAMPLE_ROWS = 6_000
#: words kept in a process with their likenesses
KEPT_WORDS = 800_000
BATCH = 4_096

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[0x0A, 0x0D, *b".!?"]] = True


def kernel(symbols: np.ndarray, others: np.ndarray, paired: bool = False) -> np.ndarray:
    """Subsequence kernel of each row of ``symbols`` with each of ``others``, or with its own.

    Rows are bytes, padded with 0. Subsequences of ORDER bytes count DECAY to the power of the
    lengths that they span in both strings, by the usual recursion over prefixes, for all pairs
    at once.
    """
    decay = np.float32(DECAY)
    shape = (len(symbols),) if paired else (len(symbols), len(others))
    span = others.shape[1]
    # before[p][j]: weight of p bytes in order, up to here and up to byte j, open to go on
    before = [[np.zeros(shape, np.float32) for _ in range(span + 1)] for _ in range(ORDER)]
    before[0] = [np.ones(shape, np.float32)] * (span + 1)
    total = np.zeros(shape, np.float32)
    for i in range(symbols.shape[1]):
        here = symbols[:, i] if paired else symbols[:, i, None]
        met = []
        for j in range(span):
            there = others[:, j]
            same = ((here == there) & (there != 0)).astype(np.float32)
            same *= decay * decay
            met.append(same)
            total += same * before[ORDER - 1][j]
        for p in range(ORDER - 1, 0, -1):
            step = None
            for j in range(span):
                found = met[j] * before[p - 1][j]
                if step is not None:
                    step *= decay
                    found += step
                step = found
                before[p][j + 1] *= decay
                before[p][j + 1] += step
    return total


def likeness(symbols: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """The kernel as a cosine, to the power SHARPNESS: again a kernel, and near 0 unless rows
    are much alike."""
    own = kernel(symbols, symbols, paired=True)
    their = kernel(landmarks, landmarks, paired=True)
    scale = np.sqrt(np.maximum(own[:, None] * their[None], 1e-12))
    return (kernel(symbols, landmarks) / scale) ** SHARPNESS


class Subsequences:
    """The same kernel against fixed rows, from the subsequences of ORDER bytes that these have.

    A word is looked through for those alone; any other adds nothing to its products with them.
    """

    def __init__(self, others: np.ndarray):
        self.base = 1 + len(np.unique(others[others > 0]))
        self.code = np.zeros(256, np.int32)
        self.code[np.unique(others[others > 0])] = np.arange(1, self.base)
        self.number = np.zeros(self.base ** ORDER, np.int32)
        at, weight = _spans(others.shape[1])
        codes = self._codes(self.code[others], at)
        kinds = np.unique(codes[codes > 0])
        self.number[kinds] = np.arange(1, len(kinds) + 1)
        self.weights = np.zeros((len(kinds) + 1, len(others)), np.float32)
        row, place = np.nonzero(codes)
        np.add.at(self.weights, (self.number[codes[row, place]], row), weight[place])

    def _codes(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A number for the bytes of each row at each of the places, 0 if one is foreign."""
        result, known = 0, True
        for places in at.T:
            byte = symbols[:, places]
            result, known = result * self.base + byte, known & (byte > 0)
        return result * known

    def products(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that have any such subsequence, and the kernel of each with the fixed rows."""
        at, weight = _spans(symbols.shape[1])
        codes = self.code[symbols]
        rows, values = [], []
        step = max(1, (1 << 20) // max(1, len(at)))
        for begin in range(0, len(codes), step):
            kinds = self.number[self._codes(codes[begin:begin + step], at)]
            row, place = np.nonzero(kinds)
            if len(row):
                first = np.flatnonzero(np.diff(row, prepend=-1))
                rows.append(begin + row[first])
                values.append(np.add.reduceat(
                    self.weights[kinds[row, place]] * weight[place, None], first, axis=0))
        if not rows:
            return np.zeros(0, np.int64), np.zeros((0, self.weights.shape[1]), np.float32)
        return np.concatenate(rows), np.concatenate(values)


@lru_cache(maxsize=WIDTH + 1)
def _spans(width: int) -> tuple[np.ndarray, np.ndarray]:
    """All choices of ORDER places in a row of ``width`` bytes, and the weight of each."""
    at = np.array([*combinations(range(width), ORDER)], np.int64).reshape(-1, ORDER)
    return at, (DECAY ** (at[:, -1] - at[:, 0] + 1)).astype(np.float32)


def as_symbols(found: list[bytes], width: int) -> np.ndarray:
    result = np.zeros((len(found), width), np.uint8)
    for k, word in enumerate(found):
        word = word[:width]
        result[k, :len(word)] = np.frombuffer(word, np.uint8)
    return result


@dataclass
class Tokens:
    """Words of texts, reduced to lower-case letters, with the hash and sentence of each."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray
    sentence: np.ndarray


def tokens(column: pa.Array) -> Tokens:
    """Words between white space, without whatever in them is no letter.

    Letters that stand alone one after another, as in a word spelled out, are one word. A sentence ends at
    a line end, or after a full stop, exclamation or question mark that white space follows.
    """
    data, begin = text_bytes(column)
    lone = _lone_gaps(data, begin)
    keep = _LETTER[data] | (~VISIBLE[data] & ~lone)
    place = np.concatenate([[0], np.cumsum(keep)])
    after = np.append(data[1:], 0x20)
    ends = (_SENTENCE_END[data] & ~VISIBLE[after]) | (data == 0x0A)
    number = np.cumsum(ends)
    kept, first_byte = _LOWER[data[keep]], place[begin]
    found = words(kept, first_byte, VISIBLE)
    # sentences are numbered through; a new text begins a new one
    text = np.searchsorted(found.first, np.arange(len(found.begin)), "right") - 1
    sentence = number[keep][found.begin] + text if len(found.begin) else number[:0]
    return Tokens(kept, found.begin, found.end, found.first, found.hash, sentence)


def _lone_gaps(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Single spaces between single ASCII letters, which a spelled-out word has."""
    n = len(data)
    gap = np.zeros(n, bool)
    if n < 3:
        return gap
    letter = _LETTER[data] & (data < 0x80)
    white = np.ones(n + 2, bool)
    white[1:-1] = ~VISIBLE[data]
    before, after = white[:-2].copy(), white[2:].copy()
    # the ends of texts count as white space
    some = begin[:-1] < begin[1:]
    before[begin[:-1][some]] = True
    after[begin[1:][some] - 1] = True
    alone = letter & before & after
    gap[1:-1] = (data[1:-1] == 0x20) & alone[:-2] & alone[2:]
    gap[begin[:-1][some]] = False
    gap[begin[1:][some] - 1] = False
    return gap


def spelled_words(found: Tokens, which: np.ndarray) -> list[bytes]:
    raw = found.data.tobytes()
    return [raw[found.begin[k]:found.end[k]] for k in which]


def windows(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words from ``begin`` to ``end``, one longer than WIDTH as windows that overlap by half.

    Returns the word, begin and length of each, the shortest first.
    """
    half, length = WIDTH // 2, end - begin
    count = np.where(length > WIDTH, -(-(length - half) // half), 1)
    word = np.repeat(np.arange(len(begin)), count)
    shift = half * (np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count))
    size = np.minimum(length[word] - shift, WIDTH)
    order = np.argsort(size, kind="stable")
    return word[order], (begin[word] + shift)[order], size[order]


class Likenesses:
    """Likeness of words to landmarks: of each landmark, the greatest of a word's windows.

    Words are kept by hash, up to ``kept`` of them; then the store starts anew.
    """

    def __init__(self, landmarks: np.ndarray, kept: int = KEPT_WORDS):
        self.landmarks, self.kept = landmarks, kept
        self.subsequences = Subsequences(landmarks)
        self.own = kernel(landmarks, landmarks, paired=True)
        self._clear()

    def _clear(self) -> None:
        # hashes in order, and which row each has
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.rows = np.zeros((0, len(self.landmarks)), np.float32)

    def computed(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A row for each of the words from ``begin`` to ``end`` of the bytes."""
        result = np.zeros((len(begin), len(self.landmarks)), np.float32)
        word, at, size = windows(begin, end)
        for k in range(int(np.searchsorted(size, ORDER)), len(word), BATCH):
            batch = slice(k, k + BATCH)
            place = np.arange(size[batch][-1])
            inside = place < size[batch, None]
            symbols = np.where(inside, data[np.where(inside, at[batch, None] + place, 0)], 0)
            rows, products = self.subsequences.products(symbols)
            symbols = symbols[rows]
            scale = np.sqrt(np.maximum(kernel(symbols, symbols, paired=True)[:, None] * self.own, 1e-12))
            np.maximum.at(result, word[batch][rows], (products / scale) ** SHARPNESS)
        return result

    def of_words(self, found: list[bytes]) -> np.ndarray:
        ends = np.cumsum([0, *map(len, found)])
        return self.computed(np.frombuffer(b"".join(found), np.uint8), ends[:-1], ends[1:])

    def of(self, found: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """The words that are like any landmark at all, and a row for each."""
        distinct, which, inverse = np.unique(found.hash, return_index=True, return_inverse=True)
        place = self._places(distinct)
        new = np.flatnonzero(place < 0)
        if len(new):
            if len(self.keys) + len(new) > self.kept:
                self._clear()
                new = np.arange(len(distinct))
            begin = len(self.keys)
            if begin + len(new) > len(self.rows):
                grown = np.zeros((max(begin + len(new), 2 * begin), len(self.landmarks)), np.float32)
                grown[:begin] = self.rows[:begin]
                self.rows = grown
            self.rows[begin:begin + len(new)] = self.computed(
                found.data, found.begin[which[new]], found.end[which[new]])
            at = np.searchsorted(self.keys, distinct[new])
            self.keys = np.insert(self.keys, at, distinct[new])
            self.place = np.insert(self.place, at, np.arange(begin, begin + len(new)))
            place = self._places(distinct)
        alike = np.flatnonzero(self.rows[place].any(axis=1)[inverse])
        return alike, self.rows[place[inverse[alike]]]

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 if it has none."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.place[at], -1)


def described(found: Tokens, known: Likenesses) -> tuple[np.ndarray, np.ndarray]:
    """The sentences of texts: their features, and the text of each."""
    first = np.flatnonzero(np.diff(found.sentence, prepend=-1))
    features = np.zeros((len(first), len(known.landmarks)), np.float32)
    alike, rows = known.of(found)
    if len(alike):
        sentence = np.searchsorted(first, alike, "right") - 1
        begin = np.flatnonzero(np.diff(sentence, prepend=-1))
        features[sentence[begin]] = np.maximum.reduceat(rows, begin, axis=0)
    return features, np.searchsorted(found.first, first, "right") - 1


#: the worst margin alone
_NO_CURVE = np.array([1.0, 0.0, 0.0, 0.0])


@dataclass
class Machine:
    """Landmarks, the weight of the likeness to each, and the curve from margin to score."""

    landmarks: np.ndarray
    weight: np.ndarray
    bias: float
    curve: np.ndarray

    def margins(self, features: np.ndarray) -> np.ndarray:
        return _row_sums(features * self.weight) + self.bias

    def evidence(self, found: Tokens, known: Likenesses) -> np.ndarray:
        """Of each text, what ``_summary`` makes of its sentences' margins."""
        n = len(found.first) - 1
        worst, total = np.full(n, self.bias), np.zeros(n)
        features, text = described(found, known)
        margin = self.margins(features)
        np.maximum.at(worst, text, margin)
        np.add.at(total, text, np.maximum(1 + margin, 0))
        return _summary(worst, total, np.bincount(text, minlength=n))

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_row_sums(_with_one(evidence) * self.curve), -50, 50)))


def _row_sums(x: np.ndarray) -> np.ndarray:
    """Sums whose rounding does not depend on how many rows come together, as that of a product does."""
    return np.ascontiguousarray(x).sum(axis=1)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def _summary(worst: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The margin of the worst sentence, up to where the machine parts the labels, the logarithm of
    one more than the sum of what sentences are short of being clear, and that of its rate among ten
    sentences."""
    return np.column_stack([
        np.minimum(worst, 1), np.log1p(total), np.log1p(10 * total / (n + 5))])


def steepest(words_of: DataFrame, residuals: DataFrame) -> list[bytes]:
    """The POOL words along which the loss falls most: the machine's slope there, squared, by its bend.

    ``words_of`` has row and word, ``residuals`` row, pull (the slope that a row adds) and weigh
    (the bend that it adds); a word's slope must be downwards, towards toxic.
    """
    slopes = (
        words_of.join(F.broadcast(residuals), "row").groupBy("word")  # a row of the sample each
        .agg(F.sum("pull").alias("pull"), F.sum("weigh").alias("weigh")).where("pull > 0"))
    gain = F.round(F.col("pull") * F.col("pull") / (F.col("weigh") + 1), 6)
    rows = slopes.orderBy(F.desc(gain), "word").limit(POOL).collect()
    if not rows:
        return []
    # words of one form are met together: each is counted with those that it is like
    found = [bytes(r.word) for r in rows]
    symbols = as_symbols(found, LANDMARK_WIDTH)
    alike = likeness(symbols, symbols).astype(np.float64)
    pull, weigh = (np.array([r[k] for r in rows], float) for k in ("pull", "weigh"))
    gains = (alike @ pull) ** 2 / (alike ** 2 @ weigh + 1)
    return [found[k] for k in np.argsort(-np.round(gains, 6), kind="stable")]


def added(landmarks: np.ndarray, found: list[bytes], most: int) -> np.ndarray:
    """The landmarks with up to ``most`` more of the words, in their order, that are little alike."""
    symbols = as_symbols(found, LANDMARK_WIDTH)
    picked = list(landmarks)
    for row in symbols:
        if len(picked) - len(landmarks) == most:
            break
        if not picked or likeness(row[None], np.array(picked)).max() < MOST_ALIKE:
            picked.append(row)
    return np.array(picked, np.uint8).reshape(-1, LANDMARK_WIDTH)


def _support_vectors(
    kernels: np.ndarray, x: np.ndarray, y: np.ndarray, cost: float = 10.0, sweeps: int = 200
) -> tuple[np.ndarray, float]:
    """Weights of the landmarks and bias of a machine with squared hinge loss; both labels weigh the same.

    ``kernels`` has the landmarks' likeness to each other, by which the Nyström map measures the
    machine's norm. No weight is negative: that a sentence lacks some word is no evidence, and
    words put into it never lower its margin. One coordinate after the other is set to where it is
    best, until none moves.
    """
    n, d = x.shape
    weigh = cost * np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    columns = [*(y[:, None] * x).T.copy(), y.astype(float)]
    kernels = kernels.astype(np.float64) + 1e-6 * np.eye(d)
    w, margin = np.zeros(d + 1), np.zeros(n)
    for _ in range(sweeps):
        moved = 0.0
        for k, column in enumerate(columns):
            short = np.maximum(1 - margin, 0)
            pull = weigh * column
            slope = -pull @ short
            bend = pull[short > 0] @ column[short > 0] + 1e-6
            if k < d:
                slope, bend = slope + kernels[k] @ w[:d], bend + kernels[k, k]
            step = -slope / bend
            if k < d:
                step = max(step, -w[k])
            if step:
                w[k] += step
                margin += step * column
                moved = max(moved, abs(step))
        if moved < 1e-6:
            break
    return w[:d], float(w[d])


def _fitted(landmarks: np.ndarray, features: np.ndarray, toxic: np.ndarray) -> Machine:
    # a sentence that is like no landmark is not toxic
    x = np.concatenate([features, np.zeros((1, len(landmarks)))])
    y = np.append(np.where(toxic > 0, 1.0, -1.0), -1.0)
    w, bias = _support_vectors(likeness(landmarks, landmarks), x, y)
    return Machine(landmarks, w, bias, _NO_CURVE)


def fit(docs: DataFrame, labels: DataFrame, work: str, rounds: int = 2) -> Machine:
    """A machine from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0 or 1).

    Of each label at most about SAMPLE_ROWS rows are learned from, whole; a third of them is kept apart for
    the curve. The sample and its sentences are stored under ``work``. If one of the labels is missing, or no
    labelled text has words, every score is the share of toxic rows. Of a doc_id that has several
    labels the greatest counts; ties among landmarks go to the words that come first. After the rounds that add
    landmarks come ``rounds`` that do not.
    """
    spark = docs.sparkSession
    found, odds = sample(docs, labels, "toxic", SAMPLE_ROWS)
    found.select(
        F.xxhash64("doc_id").alias("row"), "text", "toxic",
        (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(3)) == 0).alias("apart"),
    ).write.parquet(f"{work}/labelled")
    learned = spark.read.parquet(f"{work}/labelled")
    sizes = {r.toxic: r["count"] for r in learned.groupBy("toxic").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    machine = _trained(learned, sizes, work, rounds) if n_toxic and n_other else None
    if machine is None:
        share = np.log(n_toxic / n_other) if n_toxic and n_other else 20.0 if n_toxic else -20.0
        machine = Machine(np.zeros((1, LANDMARK_WIDTH), np.uint8), np.zeros(1), 0.0,
                          np.array([0.0, 0.0, 0.0, share]))
    # the sample may hold a larger share of one label than there is
    machine.curve[-1] -= odds
    return machine


def _trained(learned: DataFrame, sizes: dict[int, int], work: str, rounds: int) -> Machine | None:
    spark = learned.sparkSession
    sentences(learned, f"{work}/sentences")
    stored = spark.read.parquet(f"{work}/sentences")
    training = stored.where("not apart")
    (training.select("row", F.explode("words").alias("word"))
     .where(F.octet_length("word").between(ORDER, LANDMARK_WIDTH)).distinct()
     .write.parquet(f"{work}/words"))
    words_of = spark.read.parquet(f"{work}/words")
    weigh = {1: 0.5 / sizes[1], 0: 0.5 / sizes[0]}
    scale = sizes[1] + sizes[0]
    # at first no margin is kept by any row
    residuals = training.select("row", F.when(F.col("toxic") == 1, scale * weigh[1]).otherwise(
        -scale * weigh[0]).alias("pull"), F.when(F.col("toxic") == 1, scale * weigh[1]).otherwise(
        scale * weigh[0]).alias("weigh")).distinct()
    machine = Machine(np.zeros((0, LANDMARK_WIDTH), np.uint8), np.zeros(0), 0.0, _NO_CURVE)
    plain: dict[tuple[int, bytes], np.ndarray] = {}
    for number in range(LANDMARKS // ADDED + rounds):
        if number < LANDMARKS // ADDED:
            landmarks = added(machine.landmarks, steepest(words_of, residuals), ADDED)
            new = landmarks[len(machine.landmarks):]
            if len(new):
                _extended(stored, new).write.parquet(f"{work}/sentences-{number}")
                stored = spark.read.parquet(f"{work}/sentences-{number}")
            # until the machine is fitted to them, new landmarks count as one that is toxic
            machine = Machine(landmarks, np.append(machine.weight, np.ones(len(new))), machine.bias, _NO_CURVE)
            if not len(landmarks):
                return None
            more = featured([spelled.split() for _, spelled in plain], new)
            plain = {key: np.append(seen, f) for (key, seen), f in zip(plain.items(), more)}
        rows = _witnesses(stored.where("not apart"), machine)
        seen = _unpacked([r.features for r in rows], len(machine.landmarks))
        toxic = np.array([r.toxic for r in rows])
        # all that was worst in documents that are not toxic stays; they have no toxic sentence
        plain.update(((r.row, b" ".join(map(bytes, r.words))), f) for r, f in zip(rows, seen) if not r.toxic)
        disguised = _disguised([list(map(bytes, r.words)) for r in rows if r.toxic])
        bad = np.concatenate([seen[toxic == 1], featured(disguised, machine.landmarks)])
        machine = _fitted(machine.landmarks, np.concatenate([bad, *(f[None] for f in plain.values())]),
                          np.repeat([1, 0], [len(bad), len(plain)]))
        short = [(r.row, r.toxic, max(0.0, 1 - (m if r.toxic else -m)))
                 for r, m in zip(rows, machine.margins(seen).tolist())]
        residuals = spark.createDataFrame(
            [(row, scale * weigh[t] * s * (1 if t else -1), scale * weigh[t] * (s > 0))
             for row, t, s in short], "row bigint, pull double, weigh double")
    rows = _totals(stored.where("apart"), machine)
    toxic, worst, total, n = (np.array([r[k] for r in rows], float) for k in range(4))
    if len(set(toxic)) == 2:
        machine.curve = _curve(_summary(worst, total, n), toxic)
    use = machine.weight > 1e-3
    if not use.any():
        return None
    landmarks = machine.landmarks[use]
    landmarks = landmarks[:, landmarks.any(axis=0)]  # no wider than the longest
    return Machine(landmarks, machine.weight[use], machine.bias, machine.curve)


def sentences(rows: DataFrame, path: str) -> None:
    """Store the distinct words of each sentence of labelled rows; a row without any has one without."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            found = tokens(batch.column("text"))
            first = np.flatnonzero(np.diff(found.sentence, prepend=-1))
            text = np.searchsorted(found.first, first, "right") - 1
            spelled = spelled_words(found, range(len(found.begin)))
            ends = np.append(first[1:], len(spelled))
            without = np.setdiff1d(np.arange(batch.num_rows), text)
            text = np.concatenate([text, without]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(text)) for c in ("row", "toxic", "apart")),
                 pa.array([sorted(set(spelled[a:b])) for a, b in zip(first, ends)]
                          + [[]] * len(without), pa.list_(pa.binary())),
                 pa.array([b""] * len(text), pa.binary())],
                ["row", "toxic", "apart", "words", "features"])

    rows.select("row", "toxic", "apart", "text").mapInArrow(run, _SENTENCES).write.parquet(path)


_SENTENCES = "row bigint, toxic bigint, apart boolean, words array<binary>, features binary"


def _extended(stored: DataFrame, landmarks: np.ndarray) -> DataFrame:
    """The sentences with features for more landmarks, packed as 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]):
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            more = featured(batch.column("words").to_pylist(), landmarks, known).astype(np.float16)
            if len(known) > KEPT_WORDS // 8:
                known.clear()
            packed = [f.as_py() + m.tobytes() for f, m in zip(batch.column("features"), more)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "toxic", "apart", "words")),
                 pa.array(packed, pa.binary())], ["row", "toxic", "apart", "words", "features"])

    return stored.mapInArrow(run, _SENTENCES)


def _unpacked(packed: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, packed)), np.float16).reshape(-1, width).astype(np.float64)


def featured(found: list[list[bytes]], landmarks: np.ndarray, known: dict | None = None) -> np.ndarray:
    """The features of sentences, given as lists of words; ``known`` keeps those of words."""
    known = {} if known is None else known
    new = sorted({word for words_of in found for word in words_of if word not in known})
    known.update(zip(new, Likenesses(landmarks).of_words(new).astype(np.float64)))
    none = np.zeros(len(landmarks))
    return np.array([
        np.max([known[w] for w in words_of], axis=0) if words_of else none
        for words_of in found]).reshape(len(found), len(landmarks))


def _with_margins(stored: DataFrame, machine: Machine) -> DataFrame:
    """The labelled sentences with their margins; a row without words has one without."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            features = _unpacked(batch.column("features").to_pylist(), len(machine.landmarks))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "toxic", "words", "features")),
                 pa.array(machine.margins(features))], ["row", "toxic", "words", "features", "margin"])

    return stored.mapInArrow(
        run, "row bigint, toxic bigint, words array<binary>, features binary, margin double")


def _witnesses(stored: DataFrame, machine: Machine) -> list:
    """Of each labelled document its worst sentence: row, toxic, margin, words and features; the driver
    gets one a document of the sample."""
    return (
        _with_margins(stored, machine).groupBy("row")
        .agg(F.max(F.struct("margin", "words", "features", "toxic")).alias("worst"))
        .orderBy("row").select("row", "worst.*").collect())


def _totals(stored: DataFrame, machine: Machine) -> list:
    """Of each labelled document: toxic, its worst margin, the sum of 1 + margin over sentences
    with more than none, and the number of sentences."""
    return (
        _with_margins(stored, machine).groupBy("row")
        .agg(F.first("toxic").alias("toxic"), F.max("margin").alias("worst"),
             F.sum(F.when(F.size("words") > 0, F.greatest(F.col("margin") + 1, F.lit(0.0)))
                   .otherwise(0.0)).alias("total"),
             F.count_if(F.size("words") > 0).alias("n"))
        .orderBy("row").drop("row").collect())


def _disguised(found: list[list[bytes]]) -> list[list[bytes]]:
    """Sentences as they would be with a letter put into each word, and with one left out, so that
    the machine draws its margin around such forms too."""
    result = []
    for k, sentence in enumerate(found):
        at = [1 + k % max(1, len(word) - 2) if len(word) > ORDER + 1 else 0 for word in sentence]
        result.append([w[:i] + b"xqzvj"[k % 5:k % 5 + 1] + w[i:] if i else w for w, i in zip(sentence, at)])
        result.append([w[:i] + w[i + 1:] if i else w for w, i in zip(sentence, at)])
    return result


def _curve(seen: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve, by Newton steps with a little shrinkage."""
    x, w = _with_one(seen), np.zeros(seen.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + 1e-2 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(curve, x.T @ (p - toxic) + 1e-2 * w), -5, 5)
    return w


_known: dict[bytes, Likenesses] = {}


def predict(docs: DataFrame, machine: Machine) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), margin (of its worst sentence, 1 at most).

    A null or empty text, and one without letters, scores as words unlike all landmarks do.
    Reads doc_id and text alone and moves no row.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        # likenesses are kept from task to task, for these landmarks
        key = machine.landmarks.tobytes()
        if key not in _known:
            _known.clear()
            _known[key] = Likenesses(machine.landmarks)
        for batch in slices(batches, "text"):
            seen = machine.evidence(tokens(batch.column("text")), _known[key])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "score": pa.array(machine.scores(seen)),
                "margin": pa.array(seen[:, 0].copy())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, margin double")
