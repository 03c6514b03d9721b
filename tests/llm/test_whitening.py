"""Eigenpairs and whitening against numpy's."""

import duckdb
import numpy as np
import pytest

from playbill.llm import whitening
from playbill.llm.queries import QUERIES
from playbill.llm.spectrum import Slicer, inertia
from tests.llm.helpers import stored


def symmetric(rng, kind):
    n = int(rng.integers(1, 12))
    b = rng.standard_normal((n, n))
    if kind == 0:
        return b @ b.T
    if kind == 1:
        return b + b.T
    if kind == 2:
        return np.diag(rng.integers(-2, 3, n)).astype(float)
    q = np.linalg.qr(b)[0]  # eigenvalues that occur several times
    a = q @ np.diag(rng.integers(0, 3, n)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("kind", range(4))
def test_eigenpairs(kind):
    rng = np.random.default_rng(kind)
    for _ in range(40):
        a = symmetric(rng, kind)
        exact = np.linalg.eigvalsh(a)[::-1]
        for shift in (0.37, -1.21, 0.001):
            assert inertia(a - shift * np.eye(len(a))) == ((exact > shift).sum(), (exact < shift).sum())
        most = int(rng.integers(1, len(a) + 1))
        values, vectors = Slicer(a).leading(most)
        scale = max(1, np.abs(exact).max())
        exact = exact[exact > 1e-9 * scale][:most]
        assert len(values) == len(exact) and np.allclose(values, exact, atol=1e-12 * scale)
        assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-10)
        assert np.allclose(a @ vectors.T, vectors.T * values, atol=1e-11 * scale)


def plain(x, most=32):
    """deviation, whitened (up to sign) and explained by numpy's own eigenpairs, in exact integers."""
    n = len(x)
    moved = n * x.astype(object) - x.astype(object).sum(axis=0)
    centred = moved.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    return (moved * moved).sum(axis=1), centred @ vectors / np.sqrt(values), values / np.trace(
        centred.T @ centred / n)


def test_query_equals_numpys(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"select vec_id, embedding from '{sf_dir}/embeddings.parquet' order by 1").fetchall()
    x = np.floor(64 * np.array([v for _, v in rows], float)).astype(np.int64) + 1_000_000
    deviation, white, explained = plain(x)
    got = QUERIES["op12_whitening"](spark, sf_dir).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in got] == [(k, c) for k, _ in rows for c in range(1, 33)]
    assert [r.deviation for r in got[::32]] == deviation.tolist()
    mine = np.array([r.whitened for r in got]).reshape(-1, 32)
    mine *= np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white).max() < 1e-8
    assert np.allclose([r.explained for r in got[:32]], explained, rtol=1e-10)
    assert {r.n for r in got} == {len(rows)} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-10
    assert np.abs(mine.T @ mine / len(mine) - np.eye(32)).max() < 1e-10


SCHEMA = "vec_id bigint, embedding array<float>, component string, n int"


def test_odd_rows_take_no_part(spark, tmp_path):
    rng = np.random.default_rng(2)
    good = [(k // 2 or None, [float(c) for c in rng.standard_normal(3)], "a", 1) for k in range(40)]
    bad = [(90, None, "b", 2), (91, [], "b", 2), (92, [1.0, None, 2.0], "b", 2), (93, [1.0, float("nan"), 2.0], None, 2),
           (94, [1.0, float("inf"), 2.0], "b", None), (95, [1.0, 2.0], "b", 2)]
    rows = stored(spark, tmp_path, good + bad, SCHEMA)
    model = whitening.fit(rows, "embedding")
    got = whitening.whiten(rows, "embedding", model, ("vec_id",)).collect()
    assert len(got) == 3 * len(good) and {r.n for r in got} == {40}
    x = np.floor(64 * np.array([v for _, v, *_ in good], np.float32).astype(float)).astype(np.int64) + 1_000_000
    deviation, white, _ = plain(x)
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation.tolist())
    assert np.allclose(sorted(abs(r.whitened) for r in got if r.component == 3), sorted(np.abs(white[:, 2])))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 1.0])], [(1, [2.0, 3.0])] * 9])
def test_without_variance_there_are_no_components(spark, tmp_path, rows):
    docs = stored(spark, tmp_path, rows, "vec_id bigint, embedding array<double>")
    model = whitening.fit(docs, "embedding")
    assert whitening.whiten(docs, "embedding", model, ("vec_id",)).collect() == []


def test_components_without_variance_are_left_out(spark, tmp_path):
    rows = [(k, [float(k % 5), 2.0 * (k % 5), float(k % 3)]) for k in range(60)]
    docs = stored(spark, tmp_path, rows, "vec_id bigint, embedding array<double>")
    got = whitening.whiten(docs, "embedding", whitening.fit(docs, "embedding"), ("vec_id",)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-10
    assert abs(sum(r.explained for r in got if r.vec_id == 0) - 1) < 1e-12


def test_what_does_not_fit_is_refused(spark, tmp_path):
    docs = stored(spark, tmp_path, [(1, [1e30]), (2, [0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        whitening.fit(docs, "embedding")
