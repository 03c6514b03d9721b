import random

import numpy as np
import pytest

from playbill.llm import decontaminate as dc
from tests.llm.helpers import SCHEMA, fresh, plain_words

ITEMS = "item_id bigint, text string"


def expected(rows, items, window=13):
    result = {}
    for key, text in rows:
        w, hit, names = plain_words(text), set(), set()
        for name, item in items:
            iw = plain_words(item)
            size = min(window, len(iw))
            for k in range(len(iw) - size + 1 if size else 0):
                for at in range(len(w) - size + 1):
                    if w[at:at + size] == iw[k:k + size]:
                        hit.update(range(at, at + size))
                        names.add(str(name))
        result[key] = (len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w))
    return result


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = ["the", "a", "Of"] + [f"w{k}" for k in range(60)]
    words = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [(k, words(rnd.choice([1, 2, 3, 5, 12, 13, 14, 30]))) for k in range(25)] + [
        (30, None), (31, ""), (32, "!!"), (33, "the the the the the"), (12, words(20))]
    rows = []
    for k in range(60):
        text = words(rnd.choice([0, 1, 10, 200]))
        for _ in range(rnd.choice([0, 1, 3])):
            item = (rnd.choice(items)[1] or "").split()
            cut = item[:rnd.choice([len(item), 13, 12])]
            text += rnd.choice([" ", ", ", "\n"]) + " ".join(cut).upper() + "-" + words(3)
        rows.append((k, text))
    return rows + [(100, None), (101, ""), (102, "the " * 9), (103, "é" * 3 + " w1")], items


@pytest.mark.parametrize("block_bytes", [dc.BLOCK_BYTES, 60])
def test_findings_are_those_of_plain_search(spark, tmp_path, block_bytes):
    rows, items = corpus(3)
    docs = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", n_hit int").repartition(3)
    found = dc.findings(docs, spark.createDataFrame(items, ITEMS), fresh(tmp_path), block_bytes=block_bytes)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect()}
    assert got == expected(rows, items)
    assert all(r.n_items == len(r["items"]) for r in found.collect())


def test_clean_keeps_columns_and_rows_alike(spark, tmp_path):
    rows, items = corpus(4)
    verdicts = expected(rows, items)
    rows = [(*r, "m") for r in rows] + [(None, None, "m")] + [(102, "the " * 9, "m")]
    docs = spark.createDataFrame(rows, SCHEMA + ", _mark string")
    left = dc.clean(docs, spark.createDataFrame(items, ITEMS), fresh(tmp_path))
    assert left.columns == docs.columns
    wanted = sorted([k for k, *_ in rows if k is not None and not verdicts[k][3]])
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == wanted
    assert left.where("doc_id is null").count() == 1


def test_without_items_or_documents(spark, tmp_path):
    none = spark.createDataFrame([], ITEMS)
    docs = spark.createDataFrame([(1, "a b")], SCHEMA)
    assert [tuple(r)[:4] for r in dc.findings(docs, none, fresh(tmp_path)).collect()] == [(1, 2, 0, 0)]
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert dc.findings(docs.where("false"), items, fresh(tmp_path)).count() == 0


def test_the_rarest_shingle_is_the_prefix():
    windows = dc.windows_of([dc.Item("1", [b"a", b"b", b"c", b"d", b"e"])], 13)
    shingles = dc.shingles_of(windows, 2)
    (prefix,) = dc.prefixes(shingles, np.array([5, 9, 1, 9]))
    assert prefix.place.tolist() == [2]
    assert dc.prefixes(shingles, np.array([5, 9, 0, 9])) == []
