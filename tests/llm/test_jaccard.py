import random

import numpy as np
import pyarrow as pa
import pytest

from playbill.llm import jaccard
from playbill.llm.components import components
from playbill.llm.jaccard import Similarity
from tests.llm.helpers import SCHEMA, fresh, gram_set, linked_groups, stored
from tests.llm.test_words import thue_morse

ODD = [None, "", "  ", "one", "ONE", "one two", "one two three", "one  two three", "a b c d", "b a c d"]


def corpus(seed, documents=120):
    """Texts of few words, with copies, near copies in chains, and shared passages."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rnd.choices(vocabulary, k=30))
    texts = list(ODD)
    while len(texts) < documents:
        words = rnd.choices(vocabulary, k=rnd.choice([3, 8, 20, 60, 200]))
        if rnd.random() < 0.4:
            words[len(words) // 2:len(words) // 2] = passage.split()
        for _ in range(rnd.choice([1, 1, 2, 6])):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rnd.choice([0, 1, 1, 2])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
    rnd.shuffle(texts)
    return texts


def check(spark, tmp_path, texts, like):
    sets = [gram_set(t, like.words) for t in texts]
    roots = linked_groups(sets, like.percent)
    rows = [(k, t, "x") for k, t in enumerate(texts)]
    docs = stored(spark, tmp_path, rows, SCHEMA + ", class string", files=4)
    got = {r.doc_id: r for r in jaccard.similar(docs, fresh(tmp_path), like).collect()}
    assert len(got) == len(texts)
    for k, (own, root) in enumerate(zip(sets, roots)):
        assert (got[k].size, got[k]["first"].doc_id) == (len(own), root), texts[k]


@pytest.mark.parametrize("like", [Similarity(4, 85), Similarity(1, 60)])
def test_groups_are_those_of_all_pairs(spark, tmp_path, like):
    check(spark, tmp_path, corpus(like.words), like)


def test_a_group_whose_members_hardly_resemble_each_other(spark, tmp_path):
    rnd = random.Random(8)
    base = [f"b{k}" for k in range(140)]
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 2, 3, 5, 8])):
            words[rnd.randrange(140)] = f"n{rnd.random()}"
        texts.append(" ".join(words))
    check(spark, tmp_path, texts, Similarity(4, 85))


def test_members_with_many_salts_are_dealt_out_by_class(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jaccard, "SALT", 0.02)
    check(spark, tmp_path, corpus(21, 60), Similarity(4, 85))


def test_a_full_filter_lets_all_rows_pass(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_FILTER_BITS", 3)
    check(spark, tmp_path, corpus(22, 60), Similarity(4, 85))


def half_alike(n, seed=8, words=140):
    """Texts that share a base, with so many random words in it that few resemble each other."""
    rnd = random.Random(seed)
    base = [f"b{k}" for k in range(words)]
    texts = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.choice([2, 3, 5, 8])):
            own[rnd.randrange(words)] = f"n{rnd.random()}"
        texts.append(" ".join(own))
    return texts


def test_doubling_a_half_alike_group_does_not_quadruple_the_pairs(spark, tmp_path):
    seen = []
    for n in (150, 300):
        work = fresh(tmp_path)
        docs = stored(spark, tmp_path, list(enumerate(half_alike(n, words=200))))
        jaccard.similar(docs, work, Similarity(4, 85)).collect()
        seen.append(sum(spark.read.parquet(f"{work}/pairs-{k}").count() for k in (0, 1)))
    assert seen[1] < 3 * seen[0]


def test_signatures_bound_differences():
    rng = np.random.default_rng(4)
    for _ in range(200):
        whole = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64))
        a, b = (np.sort(whole[rng.random(len(whole)) < share]) for share in rng.random(2))
        bits = sum((int(x ^ y) & (1 << 64) - 1).bit_count()
                   for x, y in zip(jaccard.signature(a).tolist(), jaccard.signature(b).tolist()))
        different = len(np.setxor1d(a, b))
        assert bits <= different and bits % 2 == different % 2


def test_very_long_words_that_resemble_each_other(spark, tmp_path):
    texts = [w for n in (256, 1024) for w in thue_morse(n)] + ["a" * 200_000, "a" * 200_000 + "b", "A" * 200_000]
    check(spark, tmp_path, texts + [f"x {t} y z" for t in texts], Similarity(4, 85))


def test_repeated_rows_and_null_keys(spark, tmp_path):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, "z z"), (3, None)]
    docs = stored(spark, tmp_path, rows)
    got = sorted((r.doc_id, r["first"].doc_id, r.size) for r in
                 jaccard.similar(docs, fresh(tmp_path)).collect() if r.doc_id)
    assert got == [(3, 3, 0), (7, 7, 2), (7, 7, 2)]
    assert jaccard.keep_one(docs, fresh(tmp_path)).count() == 3


def test_an_empty_table(spark, tmp_path):
    assert jaccard.similar(stored(spark, tmp_path, [], files=1), fresh(tmp_path)).count() == 0


def test_prefixes_keep_their_promise():
    """Sets with enough in common share as many prefix members as the smaller one asks for."""
    rng, like = np.random.default_rng(1), Similarity(4, 85)
    for _ in range(300):
        expected = rng.choice([0.1, 5.0, 400.0], 1 << jaccard.SKETCH_BITS)
        whole = rng.integers(0, 1 << 63, rng.integers(1, 120)).astype(np.uint64) * np.uint64(2)
        drop = int(rng.integers(0, max(1, len(whole) // 12) + 1))
        a, b = np.unique(whole[drop:]), np.unique(whole[:len(whole) - drop // 2])
        common = len(np.intersect1d(a, b))
        if not common or 100 * common < 85 * (len(a) + len(b) - common):
            continue
        heads, asked = [], []
        for own in (a, b):
            length, matches = jaccard.prefix(own, expected, like)
            heads.append(jaccard.ordered(own, expected)[:length])
            asked.append(matches)
            assert like.least_matches(len(own)) <= matches or matches == like.least_common(len(own))
        assert len(np.intersect1d(*heads)) >= min(asked)


def test_costly_candidates_lengthen_a_prefix():
    members = np.arange(1, 201, dtype=np.uint64) << np.uint64(64 - jaccard.SKETCH_BITS)
    cheap, costly = np.full(1 << jaccard.SKETCH_BITS, 0.1), np.full(1 << jaccard.SKETCH_BITS, 0.1)
    costly[:250] = 500.0
    costly[150:250] = 1e6
    like = Similarity(4, 85)
    assert jaccard.prefix(members, costly * 0 + 500.0, like)[1] >= jaccard.prefix(members, cheap, like)[1]
    assert jaccard.prefix(members, cheap, like)[0] == 200 - 170 + jaccard.prefix(members, cheap, like)[1]


def test_classes_do_not_depend_on_word_order_of_grams():
    one, two = jaccard.sets(pa.array(["a b a b a b", "a b a b"]), 2)
    assert jaccard.class_key(one) == jaccard.class_key(two) and len(one) == 2


def test_components_of_paths_stars_and_rings(spark, tmp_path):
    rnd = random.Random(2)
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    links = [(b, a) if rnd.random() < 0.5 else (a, b) for a, b in links]
    got = components(spark.createDataFrame(links, "a bigint, b bigint"), fresh(tmp_path)).collect()
    expected = {k: 0 for k in range(1, 61)} | {k: 100 for k in range(101, 160)} | {201: 200, 202: 200}
    assert {r.node: r.component for r in got} == expected
