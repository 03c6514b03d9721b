import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from playbill.llm import toxicity as tox
from tests.llm.helpers import SCHEMA, fresh

CLEAN = "river stone garden window teacher morning letter bridge market summer idea lose clone track".split()
BAD = "grumbler blockhead snotnose".split()


def slow_kernel(s, t):
    total = 0.0
    for a in itertools.combinations(range(len(s)), tox.ORDER):
        for b in itertools.combinations(range(len(t)), tox.ORDER):
            if all(s[x] == t[y] for x, y in zip(a, b)):
                total += tox.DECAY ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_counts_weighted_subsequences():
    found = [b"idiot", b"idxiot", b"i", b"aaab", "süß".encode(), b"toidi"]
    symbols = tox.as_symbols(found, 8)
    expected = np.array([[slow_kernel(a, b) for b in found] for a in found])
    assert np.allclose(tox.kernel(symbols, symbols), expected, rtol=1e-4)
    assert np.allclose(tox.kernel(symbols, symbols, paired=True), np.diag(expected), rtol=1e-4)


def test_likenesses_from_the_landmarks_subsequences():
    """As by plain code, windows of long words and bytes that no landmark has included."""
    rnd = random.Random(3)
    def weights(word):
        found = Counter()
        for at in itertools.combinations(range(len(word)), tox.ORDER):
            found[bytes(word[k] for k in at)] += tox.DECAY ** (at[-1] - at[0] + 1)
        return found

    def plain(a, b):
        a, b = weights(a), weights(b)
        own, their = (sum(w * w for w in x.values()) for x in (a, b))
        return (sum(w * b[k] for k, w in a.items()) / (own * their) ** 0.5) ** tox.SHARPNESS if a and b else 0.0

    landmarks = [b"idiot", b"aab", "süß".encode(), b"blockhead", b"to"]
    found = [bytes(rnd.choices(b"idotablkhexqz", k=rnd.randrange(0, 40))) for _ in range(60)]
    found += [b"idiot", "süß".encode(), b"", b"zzzz", b"x" * 24 + b"idiot", b"x" * 25 + b"aab", b"a" * 61]
    got = tox.Likenesses(tox.as_symbols(landmarks, 12)).of_words(found)
    half = tox.WIDTH // 2
    for word, row in zip(found, got):
        parts = [word] if len(word) <= tox.WIDTH else [
            word[k:k + tox.WIDTH] for k in range(0, len(word) - half, half)]
        expected = [max(plain(part, landmark) for part in parts) for landmark in landmarks]
        assert np.allclose(row, expected, rtol=1e-3, atol=1e-5), word
    assert not tox.Likenesses(tox.as_symbols([b""], 12)).of_words(found).any()


def test_inserted_and_missing_letters_stay_alike():
    like = tox.likeness(tox.as_symbols([b"blockhead", b"bloxckhead", b"blckhead", b"blackboard"], 12),
                        tox.as_symbols([b"blockhead"], 12))[:, 0]
    assert like[0] == pytest.approx(1, abs=1e-4) and min(like[1:3]) > 3 * like[3]


def test_words_and_sentences():
    texts = ["You b.l-o_ck! Next one.\nThird", None, "", "a b c d. e", "x a", "b y"]
    found = tox.tokens(pa.array(texts))
    words = [[w.decode() for w in tox.spelled_words(found, range(a, b))]
             for a, b in itertools.pairwise(found.first)]
    assert words == [["you", "block", "next", "one", "third"], [], [], ["abc", "d", "e"], ["xa"], ["by"]]
    sentences = found.sentence[found.first[0]:found.first[1]]
    assert len(set(sentences.tolist())) == 3


@pytest.fixture(scope="module")
def machine(spark, tmp_path_factory):
    rnd, rows = random.Random(6), []
    for k in range(400):
        words = [rnd.choice(CLEAN) + rnd.choice(["", "s", "ly"]) for _ in range(30)]
        toxic = k % 5 == 0
        if toxic:
            words[rnd.randrange(30)] = rnd.choice(BAD)
        rows.append((k, " ".join(words), int(toxic)))
    rows += [(1000, None, 1), (1001, "river", None)]
    given = spark.createDataFrame(rows, SCHEMA + ", toxic int").repartition(2)
    return tox.fit(given, given.select("doc_id", "toxic"), str(tmp_path_factory.mktemp("fit")))


def test_gapped_and_padded_insults_are_found(spark, machine):
    rows = [(1, "the river and the garden are here"), (2, "you blockhead here"), (3, "you bl.ock-head here"),
            (4, "you blocxkhead here"), (5, "g r u m b l e r here now"), (6, None), (7, ""), (8, "12 !! 3"),
            (9, "garden " * 20_000), (9, "garden " * 20_000), (None, "market")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], SCHEMA + ", score double")
    got = {}
    for r in tox.predict(docs, machine).collect():
        got[r.doc_id] = r.score
        assert 0 <= r.score <= 1
    assert all(got[k] >= 0.3 for k in (2, 3, 4, 5)), got
    assert all(got[k] < 0.3 for k in (1, 6, 7, 8, 9, None)), got
    assert tox.predict(docs.where("false"), machine).count() == 0


def test_one_label_alone(spark, tmp_path):
    for label, side in ((0, 0.0), (1, 1.0)):
        given = spark.createDataFrame([(1, "river", label), (2, "stone", label)], SCHEMA + ", toxic int")
        alone = tox.fit(given, given, fresh(tmp_path))
        (row,) = tox.predict(spark.createDataFrame([(3, "window")], SCHEMA), alone).collect()
        assert row.score == pytest.approx(side, abs=1e-3)


def test_long_words_are_seen_in_windows(machine):
    like = tox.Likenesses(machine.landmarks).of_words([b"z" * 40 + b"blockhead" + b"q" * 30, b"z" * 79, b"", b"ab"])
    margin = machine.margins(like.astype(float))
    assert margin[0] > margin[1] and not like[2:].any()


def plain_likeness(word, landmark):
    word, landmark = ([w.encode() if isinstance(w, str) else w for w in (word, landmark)])
    own, their = slow_kernel(word, word), slow_kernel(landmark, landmark)
    return (slow_kernel(word, landmark) / (own * their) ** 0.5) ** tox.SHARPNESS if own and their else 0.0


def test_margins_are_those_of_plain_code(machine):
    """The landmark map and the margin of the worst sentence, word by word."""
    landmarks = [bytes(row[row > 0]) for row in machine.landmarks]
    texts = ["the river. you blockhead!", "garden snot nose\nstone", "", None, "grumxbler x"]
    sentences = [[["the", "river"], ["you", "blockhead"]], [["garden", "snot", "nose"], ["stone"]], [], [],
                 [["grumxbler", "x"]]]
    expected = [max([sum(w * max(plain_likeness(word, m) for word in sentence)
                         for w, m in zip(machine.weight, landmarks)) + machine.bias
                     for sentence in own], default=machine.bias) for own in sentences]
    got = machine.evidence(tox.tokens(pa.array(texts)), tox.Likenesses(machine.landmarks, kept=4))
    assert np.allclose(got[:, 0], np.minimum(expected, 1), atol=2e-2)


def test_kept_likenesses_do_not_change_results(machine):
    texts = [" ".join(random.Random(k).choices(CLEAN + BAD, k=9)) for k in range(30)]
    whole = machine.evidence(tox.tokens(pa.array(texts)), tox.Likenesses(machine.landmarks))
    small = tox.Likenesses(machine.landmarks, kept=10)
    assert np.array_equal(whole, [machine.evidence(tox.tokens(pa.array([t])), small)[0] for t in texts])


def test_the_machine_is_the_best_of_its_kind():
    """No other weights, none negative, have a smaller loss."""
    rng = np.random.default_rng(0)
    x, y = rng.random((200, 3)), np.ones(200)
    y[x[:, 0] + 2 * x[:, 1] + 0.2 * rng.standard_normal(200) < 1.2] = -1
    kernels = np.eye(3) + 0.1
    weigh = 10.0 * np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())

    def loss(w, bias):
        return w @ kernels @ w + (weigh * np.maximum(1 - y * (x @ w + bias), 0) ** 2).sum()

    w, bias = tox._support_vectors(kernels, x, y, sweeps=5000)
    best = loss(w, bias)
    assert (np.sign(x @ w + bias) == y).mean() > 0.85 and (w >= 0).all()
    for _ in range(500):
        step = 0.05 * rng.standard_normal(4)
        assert loss(np.maximum(w + step[:3], 0), bias + step[3]) >= best * (1 - 1e-6)


def test_several_labels_of_one_document_count_as_the_greatest(spark, tmp_path):
    given = spark.createDataFrame([(1, "river"), (2, "stone")], SCHEMA)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1)], "doc_id bigint, toxic int")
    alone = tox.fit(given, labels, fresh(tmp_path))
    assert tox.predict(given, alone).first().score > 0.99


def test_texts_without_words_and_landmarks_that_tie(spark, tmp_path):
    given = spark.createDataFrame([(k, "12 !", k % 2) for k in range(40)], SCHEMA + ", toxic int")
    empty = tox.fit(given, given, fresh(tmp_path))
    assert tox.predict(given, empty).first().score == pytest.approx(0.5, abs=0.1)
    given = spark.createDataFrame(
        [(k, "river alpha beta gamma" if k % 2 else "river delta omega kappa", k % 2) for k in range(60)],
        SCHEMA + ", toxic int")
    one, other = (tox.fit(given.repartition(n), given, fresh(tmp_path)) for n in (1, 4))
    assert np.array_equal(one.landmarks, other.landmarks)
    scores = {r.doc_id: r.score for r in tox.predict(given, one).collect()}
    assert all((scores[k] >= 0.3) == bool(k % 2) for k in scores)
