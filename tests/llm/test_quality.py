import numpy as np
import pyarrow as pa
import pytest

from playbill.llm import quality
from tests.llm.helpers import SCHEMA

TEXTS = [None, "", " ", "One two. One two.\nOne two.", "a a a a b", "LOUD!! TEXT!!", "x | y | z", "Zażółć 12 gęś",
         "word " * 30_000]


def test_features_of_plain_definitions():
    got = {name: column for name, column in zip(quality.FEATURES, quality.features(pa.array(TEXTS)).T)}
    for k, text in enumerate(TEXTS):
        words = (text or "").split()
        some = max(len(words), 1)
        lower = [w.lower() for w in words]
        assert got["log_words"][k] == pytest.approx(np.log1p(len(words)))
        assert got["distinct_words"][k] == pytest.approx(len(set(lower)) / some)
        assert got["same_as_before"][k] == pytest.approx(sum(a == b for a, b in zip(lower, lower[1:])) / some)
        triples = list(zip(lower, lower[1:], lower[2:]))
        assert got["distinct_triples"][k] == pytest.approx(len(set(triples)) / max(len(triples), 1))
        lines = [x for x in (text or "").lower().split("\n") if x]
        assert got["distinct_lines"][k] == pytest.approx(len(set(lines)) / max(len(lines), 1))
        assert got["commonest_word"][k] == pytest.approx(max(map(lower.count, set(lower)), default=0) / some)
        assert got["exclamations"][k] == pytest.approx((text or "").count("!") / some)
    # each text is described on its own
    for k, text in enumerate(TEXTS):
        alone = quality.features(pa.array([text], pa.string()))[0]
        assert np.allclose(alone, [c[k] for c in got.values()])


def test_pairs_are_learned_when_features_alone_say_nothing():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = quality.train(x[:2000], y[:2000])
    assert (0, 2) in model.pairs
    assert ((model.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.random((500, 3))
    model = quality.train(x, (x[:, 1] > 0.3).astype(float))
    for row in x[:20]:
        total = model.start + sum(
            t[np.searchsorted(e, v, "right")] for e, t, v in zip(model.edges, model.tables, row))
        for (i, j), t in zip(model.pairs, model.pair_tables):
            total += t[np.searchsorted(model.pair_edges[i], row[i], "right"),
                       np.searchsorted(model.pair_edges[j], row[j], "right")]
        assert model.scores(row[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_fit_and_predict_over_odd_rows(spark):
    rows = [(k, ("LOUD!! " * 9) if k % 3 else f"Calm words number {k} stand here.", int(k % 3 == 0)) for k in range(90)]
    given = spark.createDataFrame(rows + [(500, "x", None), (0, "again", 0)], SCHEMA + ", quality int")
    model = quality.fit(given.repartition(3), given.select("doc_id", "quality"))
    docs = spark.createDataFrame(
        [(k, t, "c") for k, t in enumerate(TEXTS)] + [(None, "x", "c"), (1, "", "c")], SCHEMA + ", quality string")
    got = quality.predict(docs, model).collect()
    assert len(got) == len(TEXTS) + 2 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.score for r in got}[5] < 0.5
    assert quality.predict(docs.where("false"), model).count() == 0
    none = spark.createDataFrame([], SCHEMA + ", quality int")
    none = quality.fit(none, none)
    assert {r.score for r in quality.predict(docs, none).collect()} == {0.5}
