import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from playbill.llm import language as lang
from tests.llm.helpers import SCHEMA

WORDS = {
    "en": "the and of with this that house water morning people would through thing".split(),
    "de": "der und mit nicht schön straße müssen wieder können zwischen für größe".split(),
    "ru": "и не что это дом вода утро люди через между хорошо большой".split(),
}


def text_of(rnd, code, n):
    return " ".join(rnd.choices(WORDS[code], k=n)) + "."


@pytest.fixture(scope="module")
def model(spark):
    rnd = random.Random(1)
    rows = [(k, text_of(rnd, c, 40), c) for k in range(20) for c in WORDS]
    rows += [(900, None, "en"), (901, "unlabelled", None), (902, "", "de")]
    return lang.learn(spark.createDataFrame(rows, SCHEMA + ", lang string").repartition(3))


def test_languages_and_scripts_are_learned(model):
    assert model.languages == ["de", "en", "ru"]
    latin, cyrillic = (1 << list(lang.SCRIPTS).index(s) for s in ("Latin", "Cyrillic"))
    assert model.scripts.tolist() == [latin, latin, cyrillic]


def test_mixed_text_falls_into_spans(model):
    rnd = random.Random(2)
    parts = [("en", text_of(rnd, "en", 15)), ("ru", text_of(rnd, "ru", 20)), ("de", text_of(rnd, "de", 15))]
    text = " ".join(t for _, t in parts)
    ((label, score, spans),) = lang.labelled_spans(pa.array([text]), model)
    assert [s[2] for s in spans] == ["en", "ru", "de"]
    raw = text.encode()
    for (_, own), (begin, end, _) in zip(parts, spans):
        assert raw[begin:end].decode() == own.rstrip(".")
    assert label == "ru" and 0 < score < 1


def test_texts_without_letters_and_odd_rows(spark, model):
    rows = [(1, None, 5), (2, "", 5), (3, "12 + 3 … «»", 5), (None, "the house", 5), (4, "дом", 5), (4, "дом", 5),
            (5, "日本語", 5), (6, "the " * 30_000, 5)]
    docs = spark.createDataFrame(rows, SCHEMA + ", score int")
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in lang.predict(docs, model).collect()), key=repr)
    assert [g[:2] for g in got if g[0] in (1, 2, 3, None, 4, 6)] == [
        (1, "und"), (2, "und"), (3, "und"), (4, "ru"), (4, "ru"), (6, "en"), (None, "en")]
    assert all(0 <= g[2] <= 1 for g in got)
    left = lang.keep_known(docs, model, 0.3)
    assert left.columns == docs.columns and left.where("doc_id in (1, 2, 3)").count() == 0
    assert left.where("doc_id = 4").count() == 2


def test_nothing_learned_or_given(spark, model):
    empty = spark.createDataFrame([], SCHEMA + ", lang string")
    none = lang.learn(empty)
    assert none.languages == []
    assert lang.predict(empty, model).count() == 0
    docs = spark.createDataFrame([(1, "the house")], SCHEMA)
    assert [tuple(r)[1:3] for r in lang.predict(docs, none).collect()] == [("und", 0.0)]


def test_the_path_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, k = rng.integers(1, 7), rng.integers(1, 4)
        scores = rng.normal(0, 3, (n, k)).astype(np.float32)
        switch = float(rng.choice([0.5, 3, 9]))

        def value(path):
            return sum(scores[i, p] for i, p in enumerate(path)) - switch * sum(
                a != b for a, b in itertools.pairwise(path))

        best = max(value(p) for p in itertools.product(range(k), repeat=int(n)))
        assert value(lang.best_path(scores, switch)) == pytest.approx(best, abs=1e-4)


def test_scripts_by_code_point():
    data = np.frombuffer("aé1жΩ語 ".encode(), np.uint8)
    found = [int(b).bit_length() - 1 for b in lang.script_bits(data) if b]
    assert [list(lang.SCRIPTS)[k] for k in found] == ["Latin", "Latin", "Cyrillic", "Greek", "Han"]
