import random

import numpy as np
import pyarrow as pa

from playbill.llm.arrow import slices, text_bytes
from playbill.llm.words import ALPHANUMERIC, VISIBLE, runs, words
from tests.llm.helpers import plain_words, visible_words

TEXTS = ["", "Ab cd", " x", "y ", None, "a\tb\nc\x0bd", "né Ñandú-3x", "\x00a\x7fb", "日本 語", "a", "A"]


def random_texts(seed, n=40):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("aB1 \n-éß語") for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def test_words_are_those_of_the_pattern():
    for texts in (TEXTS, random_texts(1)):
        for members, plain in ((VISIBLE, visible_words), (ALPHANUMERIC, plain_words)):
            data, begin = text_bytes(pa.array(texts, pa.string()))
            found = words(data, begin, members)
            raw = data.tobytes()
            for k, text in enumerate(texts):
                own = range(found.first[k], found.first[k + 1])
                got = [raw[found.begin[i]:found.end[i]].decode(errors="surrogateescape") for i in own]
                lower = {i: i + 32 for i in range(65, 91)}
                assert [w.translate(lower) for w in got] == plain(text)


def test_hashes_tell_words_apart_and_not_case_or_place():
    texts = random_texts(2, 200)
    data, begin = text_bytes(pa.array(texts))
    found = words(data, begin, VISIBLE)
    spelled = [w for t in texts for w in visible_words(t)]
    by_hash = {}
    for word, value in zip(spelled, found.hash.tolist()):
        assert by_hash.setdefault(value, word) == word
    assert len(by_hash) == len(set(spelled))


def test_runs_depend_on_order_and_length():
    h = np.arange(1, 6, dtype=np.uint64)
    assert len(set(runs(h, 2).tolist()) | set(runs(h[::-1].copy(), 2).tolist())) == 8
    assert len(runs(h, 6)) == 0


def test_slices_keep_all_rows_whole():
    texts = ["a" * n for n in (3, 100, 0, 5, 5, 5)] + [None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "k": list(range(7))})
    parts = list(slices(iter([batch, batch.slice(2, 3)]), "text", 10))
    assert [x for p in parts for x in p["k"].to_pylist()] == [*range(7), 2, 3, 4]
    assert all(len(text_bytes(p["text"])[0]) <= 10 or p.num_rows == 1 for p in parts)


def thue_morse(n):
    """A word over a and b, and its complement; a polynomial modulo 2**64 tells them not apart."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_hashes_have_no_structural_collisions():
    texts = [w for n in (256, 1024, 4096) for w in thue_morse(n)]
    texts += ["ab" * 40, "ba" * 40, "a" * 80, "a" * 81, "aa\x00", "aa", "xa" * 33, "ax" * 33]
    data, begin = text_bytes(pa.array(texts))
    assert len(set(words(data, begin, VISIBLE).hash.tolist())) == len(texts)
