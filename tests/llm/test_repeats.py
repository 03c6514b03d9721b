import hashlib
import random

import numpy as np
import pytest

from playbill.llm import repeats, suffixes
from tests.llm.helpers import SCHEMA, fresh, stored


def test_suffixes_are_in_order():
    rnd = random.Random(3)
    for _ in range(300):
        text = bytes(rnd.choice(b"ab\0c") for _ in range(rnd.randint(0, 60)))
        depth = rnd.choice([1, 5, 70])
        order = suffixes.suffix_order(text, depth).tolist()
        assert sorted(order) == list(range(len(text)))
        heads = [text[i:i + depth] for i in order]
        assert heads == sorted(heads)


def test_common_prefixes():
    rnd = random.Random(4)
    text = bytes(rnd.choice(b"ab") for _ in range(200)) * 2
    a, b = (np.array([rnd.randrange(400) for _ in range(300)]) for _ in range(2))
    for x, y, n in zip(a, b, suffixes.common_prefixes(text, a, b, 60)):
        if x != y:
            s, t = text[x:] + bytes(70), text[y:] + bytes(70)
            assert n == next((i for i in range(60) if s[i] != t[i]), 60)


def test_windows_that_start_elsewhere():
    rnd = random.Random(5)
    for _ in range(200):
        parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 30))) for _ in range(4)]
        length = rnd.choice([3, 8, 9, 11])
        windows = [p[i:i + length] for p in parts for i in range(len(p) - length + 1)]
        for part, flags in zip(parts, suffixes.repeated_windows(parts, length)):
            assert flags.tolist() == [
                windows.count(part[i:i + length]) > 1 for i in range(len(part) - length + 1)]


def expected(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for k, d in enumerate(data):
        for i in range(len(d) - length + 1):
            seen.setdefault(d[i:i + length], []).append((k, i))
    gone = [np.zeros(len(d) + 2, bool) for d in data]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i + 1:i + length + 1] = True
    result = []
    for d, g in zip(data, gone):
        kept = bytes(b for b, x in zip(d, g[1:]) if not x)
        result.append((len(d), int(g.sum()), int((g[1:] & ~g[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return result


def corpus(seed):
    rnd = random.Random(seed)
    letters = lambda n: "".join(rnd.choice("abcdefé ") for _ in range(n))
    passages = [letters(rnd.choice([39, 40, 41, 60, 200])) for _ in range(6)]
    texts = [None, "", "x" * 39, "y" * 40, "z" * 300, "ab" * 100]
    for _ in range(70):
        text = letters(rnd.choice([0, 5, 100]))
        for _ in range(rnd.choice([0, 1, 2])):
            text += rnd.choice(passages) + letters(rnd.choice([0, 3, 50]))
        texts.append(text)
    return texts + [texts[-1], texts[-1], "w" * 20, "w" * 20]


def check(spark, tmp_path, texts):
    docs = stored(spark, tmp_path, [(k, t, 1) for k, t in enumerate(texts)], SCHEMA + ", class int", files=4)
    got = repeats.remove_repeats(docs, fresh(tmp_path), length=40, run=13).collect()
    facts = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got}
    assert len(got) == len(texts)
    for k, own in enumerate(expected(texts, 40)):
        assert facts[k] == own, texts[k]
    for r in got:
        assert sum(s.end - s.begin for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans


def test_what_stays_is_what_plain_search_leaves(spark, tmp_path):
    check(spark, tmp_path, corpus(1))


@pytest.mark.parametrize("hot", [1, 400])
def test_anchors_that_fill_several_blocks(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_BYTES", hot)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 500)
    check(spark, tmp_path, corpus(2))


def test_null_keys_and_an_empty_table(spark, tmp_path):
    docs = stored(spark, tmp_path, [(None, "q" * 50), (None, "q" * 50), (1, "r" * 10)])
    got = repeats.remove_repeats(docs, fresh(tmp_path), length=40, run=13)
    assert sorted(r.n_removed for r in got.collect()) == [0, 50, 50]
    assert repeats.remove_repeats(stored(spark, tmp_path, [], files=1), fresh(tmp_path)).count() == 0
