import zlib
from collections import Counter

import numpy as np

from playbill.llm.shards import numbered, permuted, place, shard
from tests.llm.helpers import SCHEMA


def test_every_size_is_permuted():
    for n in [*range(1, 70), 1000, 4097]:
        for seed in (0, 7):
            assert sorted(permuted(np.arange(n), n, seed).tolist()) == list(range(n))
    assert permuted(np.arange(1000), 1000, 0).tolist() != permuted(np.arange(1000), 1000, 1).tolist()


def test_neighbours_are_spread():
    at = permuted(np.arange(10_000), 10_000)
    assert abs(np.corrcoef(np.arange(10_000), at)[0, 1]) < 0.05


def test_shards_are_even_gapless_and_computable(spark):
    texts = ["", None, "é", "same", "same"] + [f"text {k}" for k in range(96)]
    rows = [(k, t, 9) for k, t in enumerate(texts)] + [(3, "same", 9), (None, "z", 9)]
    docs = spark.createDataFrame(rows, SCHEMA + ", shard int")
    got = shard(docs.repartition(5), 8).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    for r in got:
        assert place(r.row_number, len(rows), 8) == (r.shard, r.slot)
    facts = {k: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t, _ in rows if k is not None}
    assert all(facts[r.doc_id] == (r.size, r.text_crc32) for r in got if r.doc_id is not None)
    # the layout does not matter
    assert sorted(map(repr, got)) == sorted(map(repr, shard(docs.coalesce(1), 8).collect()))


def test_numbers_of_one_common_value(spark):
    rows = spark.range(5000).selectExpr("cast(id % 3 = 0 as int) as k")
    got = numbered(rows, "k").collect()
    assert sorted(r.row_number for r in got) == list(range(5000))
    assert max(r.row_number for r in got if r.k == 0) < min(r.row_number for r in got if r.k == 1)


def test_an_empty_table(spark):
    assert shard(spark.createDataFrame([], SCHEMA), 4).count() == 0
