"""Exact top-k search against all scores."""

import numpy as np
import pyarrow as pa
import pytest

from playbill.llm import topk
from tests.llm.helpers import fresh, stored

SCHEMA = "vec_id bigint, embedding array<float>, x string, row int"


def nothing(queries):
    return [tuple(np.zeros(0, np.int64) for _ in range(3))] * len(queries)


def test_lists_give_what_all_scores_give(monkeypatch):
    monkeypatch.setattr(topk, "TOGETHER", 3)
    rng = np.random.default_rng(0)
    for trial in range(120):
        n, d, reach = (int(rng.integers(1, most)) for most in (300, 9, 30))
        x = rng.integers(-reach, reach + 1, (n, d))
        if trial % 3 == 0:
            x[:n // 2] = x[0]  # ties
        if trial % 5 == 0:
            x[0] = 0
        ids, rows, k = rng.integers(0, n, n), rng.permutation(n), int(rng.integers(1, 12))
        asked = np.arange(min(5, n))
        state = nothing(asked)
        for begin in range(0, n, 64):
            part = slice(begin, begin + 64)
            topk.search(pa.table({"row": rows[part], "vec_id": ids[part], "x": pa.array(
                list(x[part]), pa.list_(pa.int64()))}), (rows[asked], x[asked]), state, k)
        for i in asked:
            score, others = x @ x[i], np.arange(n) != i
            best = np.lexsort((rows[others], ids[others], -score[others]))[:k]
            assert state[i][0].tolist() == score[others][best].tolist()
            assert state[i][1].tolist() == ids[others][best].tolist()


def test_reading_stops_before_the_lists_end(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (4000, 4))
    x[:20] *= 20
    lists = topk.Lists(x, np.arange(4000), np.arange(4000))
    read = []
    order = lists.order

    class Watched(np.ndarray):
        def __getitem__(self, key):
            read.append(len(range(*key.indices(4000))) if isinstance(key, slice) else 0)
            return super().__getitem__(key)

    lists.order = [row.view(Watched) for row in order]
    found = lists.best(np.array([[3, -1, 2, 5]]), np.array([-1]), 5, np.array([-np.inf]))
    assert len(found[0]) <= topk.LEFT * 5
    assert sum(read) < 4 * 4000  # both ends of each list are offered, of 8 x 4000 in all


def plain(rows, divisor=100, k=10):
    given = [(key, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int)) for key, v in rows]
    result = []
    for i, (key, x) in enumerate(given):
        if key % divisor == 0:
            best = sorted((-int(y @ x), other) for j, (other, y) in enumerate(given) if j != i)[:k]
            result += [(key, rank, other, -s) for rank, (s, other) in enumerate(best, 1)]
    return sorted(result)


@pytest.mark.parametrize("query_bytes", [4 << 20, 40])
def test_rows_of_every_kind(spark, tmp_path, monkeypatch, query_bytes):
    monkeypatch.setattr(topk, "QUERY_BYTES", query_bytes)
    rng = np.random.default_rng(3)
    good = [(int(k), [float(c) for c in rng.standard_normal(4)]) for k in range(0, 330, 3)]
    good += [(7, [0.25] * 4)] * 15 + [(300, good[0][1])] * 3 + [(600, [0.0] * 4)]
    bad = [(100, None), (100, []), (200, [1.0, None, 1.0, 1.0]), (400, [float("nan")] * 4),
           (500, [float("-inf")] * 4), (700, [9.0] * 3), (None, [5.0] * 4)]
    rows = stored(spark, tmp_path, [(*r, "x", 1) for r in good + bad], SCHEMA)
    got = topk.top_k(rows, fresh(tmp_path)).collect()
    assert sorted(map(tuple, got)) == plain(good)


@pytest.mark.parametrize("rows, n", [([], 0), ([(1, [1.0])], 0), ([(0, [1.0])], 0), ([(0, [1.0]), (1, [2.0])], 1)])
def test_few_rows(spark, tmp_path, rows, n):
    docs = stored(spark, tmp_path, rows, "vec_id bigint, embedding array<float>")
    assert topk.top_k(docs, fresh(tmp_path)).count() == n


def test_blocks_without_queries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BYTES", 1)
    good = [(k, [float(k % 7)]) for k in range(0, 300, 50)]
    rows = stored(spark, tmp_path, good, "vec_id bigint, embedding array<float>")
    got = topk.top_k(rows, fresh(tmp_path)).collect()
    assert sorted(map(tuple, got)) == plain(good)


def test_no_python_collects_all_queries(spark, tmp_path, monkeypatch):
    """Queries of one id, however many, are spread over blocks."""
    monkeypatch.setattr(topk, "QUERY_BYTES", 160)
    work = fresh(tmp_path)
    rows = stored(spark, tmp_path, [(0, [float(k % 7)]) for k in range(200)], "vec_id bigint, embedding array<float>")
    topk.top_k(rows, work)
    sizes = [r["count"] for r in spark.read.parquet(f"{work}/queries").groupBy("block").count().collect()]
    assert sum(sizes) == 200 and max(sizes) < 60
