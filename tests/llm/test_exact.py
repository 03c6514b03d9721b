import hashlib
import re

from pyspark.sql import functions as F

from playbill.llm import exact
from tests.llm.helpers import SCHEMA, fresh, stored


def content(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    """doc_id, keep_id, group_size, digest per row, and the number of rows kept."""
    groups = {}
    for key, text, *_ in rows:
        groups.setdefault(content(text), []).append((-len(text or ""), key is None, key or 0, key))
    result = []
    for key, text, *_ in rows:
        own = groups[content(text)]
        result.append((key, min(own, key=lambda x: x[:3])[3], len(own),
                       hashlib.sha256(content(text).encode()).hexdigest()))
    return sorted(result, key=repr), len(groups)


ROWS = [
    (1, "a b"), (2, "ab"), (3, "a  b"), (4, "a\x0bb\n"), (5, None), (6, ""), (7, " \t"), (8, "other"),
    (8, "other"), (None, "other"), (None, "alone"), (9, "a b"), (10, "é "), (11, "é"), (12, "x" * 50_000),
    (13, "x" * 50_000 + "y"), (14, "x" * 50_000),
]


def facts(got):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.digest) for r in got), key=repr)


def test_groups_and_the_one_that_stays(spark, tmp_path):
    docs = stored(spark, tmp_path, [(*r, "c", 1) for r in ROWS], SCHEMA + ", digest string, group_size int")
    got = exact.deduplicate(docs, fresh(tmp_path)).collect()
    rows, groups = expected(ROWS)
    assert facts(got) == rows
    assert sum(r.kept for r in got) == groups
    assert all(r.keep_id == r.doc_id for r in got if r.kept)
    left = exact.keep_one(docs, fresh(tmp_path))
    assert left.columns == docs.columns and left.count() == groups


def test_texts_are_compared_when_digests_agree(spark, tmp_path):
    def weak(text):
        return F.length(text).cast("string")

    docs = stored(spark, tmp_path, ROWS)
    got = exact.deduplicate(docs, fresh(tmp_path), weak).collect()
    rows, groups = expected(ROWS)
    assert sorted((x[:3] for x in facts(got)), key=repr) == sorted((x[:3] for x in rows), key=repr)
    assert sum(r.kept for r in got) == groups


def test_a_stream_goes_on_with_its_state(spark, tmp_path):
    work = fresh(tmp_path)
    for part in (ROWS[:6], ROWS[6:9], ROWS[9:]):
        exact.arrive(stored(spark, tmp_path, part), f"{work}/arrivals")
        exact.drain(spark, f"{work}/arrivals", f"{work}/checkpoint")
    groups = {(r.digest, r.group_size, r.keep_id) for r in exact.state(spark, f"{work}/checkpoint").collect()}
    assert groups == {(d, n, k) for _, k, n, d in expected(ROWS)[0]}


def test_a_third_of_all_rows_alike(spark, tmp_path):
    rows = [(k, "same" if k % 3 == 0 else f"t{k}") for k in range(3000)]
    got = exact.deduplicate(stored(spark, tmp_path, rows), fresh(tmp_path))
    assert got.where("kept").count() == 2001
    assert got.where("keep_id = 0 and group_size = 1000").count() == 1000


def test_an_empty_table(spark, tmp_path):
    docs = stored(spark, tmp_path, [], files=1)
    assert exact.deduplicate(docs, fresh(tmp_path)).count() == 0


def test_no_python_in_the_plan(spark, tmp_path):
    docs = stored(spark, tmp_path, ROWS)
    plan = exact.deduplicate(docs, fresh(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
