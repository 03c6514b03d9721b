"""The registered queries against their SQL, plain code, or the labels held out."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from playbill.llm.oracle import ORACLE
from playbill.llm.queries import QUERIES
from tests.compare import connect, differences

SF_DIR, MORE, MOST = (f"/root/testdata/sf{sf}" for sf in ("0.001", "0.01", "0.1"))


def documents(sf_dir=SF_DIR):
    return duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet' order by doc_id").fetchall()


def test_there_is_a_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert ORACLE.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []


def test_token_files_hold_what_the_library_encodes(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = {r.doc_id: r for r in QUERIES["op3_token_files"](spark, SF_DIR).collect()}, 0
    for key, text in documents():
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[key].start, got[key].n_tokens, got[key].ids_crc32) == (
            start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_encoding_is_the_librarys(spark):
    import tiktoken

    from playbill.llm import bpe
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoder = bpe.encoding(path, public_tokenizers.PATTERN)
    assert isinstance(encoder, tiktoken.Encoding)
    got = {r.doc_id: r for r in QUERIES["op2_byte_bpe"](spark, SF_DIR).collect()}
    for key, text in documents():
        ids = " ".join(map(str, encoder.encode_ordinary(text or ""))).encode()
        assert got[key].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got[key].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def held_out(spark, name, label, table, sf_dir):
    truth = dict(duckdb.sql(f"select doc_id, {label} from '{sf_dir}/{table}.parquet' where {label} is not null").fetchall())
    return [(r, truth[r.doc_id]) for r in QUERIES[name](spark, sf_dir).collect()
            if r.held_out and r.doc_id in truth]


def test_languages_of_documents_held_out(spark):
    rows = held_out(spark, "op7_language", "lang", "documents", MORE)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r, _ in rows)
    assert np.mean([r.lang_pred == truth for r, truth in rows]) > 0.98


def test_quality_of_documents_held_out(spark):
    rows = held_out(spark, "op9_quality", "quality", "labels", MORE)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r, _ in rows)
    assert np.mean([r.predicted == truth for r, truth in rows]) > 0.95


def test_toxicity_of_documents_held_out(spark):
    rows = held_out(spark, "op8_toxicity", "toxic", "labels", MOST)
    toxic = [r.predicted for r, truth in rows if truth]
    clean = [r.predicted for r, truth in rows if not truth]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.04
