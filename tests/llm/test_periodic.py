"""Periodic runs against a walk over every diagonal."""

import hashlib
import random

import numpy as np
import pytest

from playbill.llm import periodic
from tests.llm.helpers import stored


def plain_runs(words, least=12):
    """(start, length, period) of all runs: every diagonal from end to end."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            begin = i
            while i < n and words[i] == words[i - q]:
                i += 1
            length = i - begin + q
            if i > begin and length >= max(least, 2 * q):
                found.setdefault((begin - q, length), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def odd_sequence(rng):
    n, k = rng.randrange(130), rng.choice([1, 2, 2, 3, 5, 30])
    words = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randrange(2, 11)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.5:
            words[rng.randrange(n)] = 0
        if rng.random() < 0.3:
            words = words + words[:n // 2] + words
    return words


@pytest.mark.parametrize("pairs", [1 << 20, 300, 37])
def test_runs_are_those_of_all_diagonals(monkeypatch, pairs):
    monkeypatch.setattr(periodic, "PAIRS", pairs)
    rng = random.Random(pairs)
    for _ in range(400):
        words, least = odd_sequence(rng), rng.choice([12, 12, 5, 2, 1, 20])
        got = [tuple(map(int, row)) for row in periodic.runs_of(np.array(words, np.int64), least)]
        assert got == plain_runs(words, least), (words, least)


@pytest.mark.parametrize("words", [
    np.zeros(200_000, int), np.tile(np.arange(10), 20_000),
    np.tile(np.random.default_rng(0).integers(0, 50, 1000), 200)])
def test_one_long_run(words):
    n, p = len(words), len(set(words.tolist())) if len(words) == 200_000 else 1
    found = periodic.runs_of(words)
    assert len(found) >= 1 and found[0][0] == 0 and found[0][1] == n and found[0][2] >= min(p, 10) - 9


def plain(text):
    words = (text or "").encode().split()
    rows = plain_runs(words)
    gone = {i for s, n, q in rows for i in range(s + q, s + n)}
    return len(words), rows, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def test_rows_of_every_kind(spark, tmp_path):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "one", "a " * 11, "a " * 12, "a\x0bb\x0cc " * 30, "ß " * 40 + "B b " * 9,
             "a b " * 13, "x " + "w1 w2 w3 w4 w5 w6 w7 " * 2 + "w1 y", "\x00 " * 15,
             "a" * 100_000 + " b" * 20]
    texts += [" ".join(f"w{w}" for w in odd_sequence(rng)) for _ in range(60)]
    rows = [(k if k else None, t, k, "r") for k, t in enumerate(texts)] * 2
    docs = stored(spark, tmp_path, rows, "doc_id bigint, text string, n_words int, runs string")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                  for r in periodic.detect(docs).collect()), key=str)
    assert got == sorted(((key, *plain(text)) for key, text, *_ in rows), key=str)


def test_no_rows(spark, tmp_path):
    assert periodic.detect(stored(spark, tmp_path, [])).collect() == []


def test_every_tenth_text_becomes_periodic(spark, tmp_path):
    import zlib

    from playbill.llm.queries import with_periodic_tails
    rng = random.Random(1)
    rows = [(k, "  ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 1, 2, 7, 300]))))
            for k in range(300)] + [(None, "a b c"), (301, None)]
    got = {(r.doc_id, r.text) for r in with_periodic_tails(stored(spark, tmp_path, rows)).collect()}
    expected = set()
    for key, text in rows:
        words, h = (text or "").split(), 0 if key is None else zlib.crc32(str(key).encode())
        if key is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
        expected.add((key, text))
    assert got == expected


def test_digests_of_a_run(spark, tmp_path):
    import playbill.llm.queries as queries
    text = "x " + "a b c " * 5 + "y"
    folder = f"{tmp_path}/t"
    spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string").write.parquet(
        f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, folder).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period) == (1, 1, 15, 3)
    assert got[1].exponent_milli == 5000
    assert got[1].runs_sha256 == hashlib.sha256(b"1,15,3\n").hexdigest()
    assert got[1].collapsed_sha256 == hashlib.sha256(b"x a b c y").hexdigest()
    assert (got[2].n_runs, got[2].start, got[2].exponent_milli) == (0, None, None)
    assert got[2].runs_sha256 == got[2].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
