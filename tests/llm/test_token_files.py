import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from playbill.llm import token_files as tf
from tests.llm.helpers import SCHEMA, fresh

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  b", "a \n b.", "x\t y", "don't, 's!", " lead", "trail ", "é.ü!", " x", "..,", "a\x1c b", "(1)2,3",
       "see <|endoftext|> here", "a  <|endoftext|>  b", "<|endoftext|><|endoftext|>.", "x<|endoftext|>,y", "<|endoftext| >",
       "\n<|endoftext|>\n \n", "<|endoftext|>!"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def test_pieces_encode_like_the_whole(plain):
    rnd, encode = random.Random(5), tf.piece_encoder.__wrapped__(PATH, kept=20)
    texts = ODD + ["".join(rnd.choice(["a", "B", "7", " ", "\n", "'s", ".", "!", "é", "\t", "\x1c", " "])
                           for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    for text in texts:
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_files_hold_ids_in_order(spark, tmp_path, plain):
    rows = [(k, t) for k, t in enumerate(ODD * 3)] + [(5, "again"), (5, "again"), (None, None), (99, None)]
    rows = [(k, t, 1, 2) for k, t in rows]
    docs = spark.createDataFrame(rows, SCHEMA + ", start int, pack int").repartition(3)
    path = fresh(tmp_path)
    tf.write_token_files(docs, path, PATH, end_id=2, pack_bytes=50)
    got = tf.read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    start = 0
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    expected = sorted((k, tuple(plain.encode(t or "").ids + [2])) for k, t, *_ in rows if k is not None)
    assert sorted((r.doc_id, tuple(r.ids)) for r in got if r.doc_id is not None) == expected
    assert [x.tolist() for x in tf.read_document(spark, path, 2)] == [plain.encode("a  b").ids + [2]]


def test_a_trained_dictionary_is_checked(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"the {k} and the other {k * k} of them all {k % 7}") for k in range(600)], SCHEMA)
    path = fresh(tmp_path)
    tf.write_token_files(docs, path, PATH, end_id=2)
    dictionary = tf.read_dictionary(spark, path)
    assert dictionary
    data = bytes(spark.read.parquet(f"{path}/packs").first()["pack"])
    assert tf.Pack(data, dictionary)[0][-1] == 2
    with pytest.raises(ValueError):
        tf.Pack(data, dictionary + b"x")
    assert tf.read_token_files(spark, path).count() == 600


def test_wide_ids_and_an_empty_table(spark, tmp_path):
    one = tf.pack([np.array([70_000, 1]), np.array([], np.int64)], b"", 4)
    assert [x.tolist() for x in (tf.Pack(one, b"")[0], tf.Pack(one, b"")[1])] == [[70_000, 1], []]
    path = fresh(tmp_path)
    tf.write_token_files(spark.createDataFrame([], SCHEMA), path, PATH, end_id=2)
    assert tf.read_token_files(spark, path).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        tf.write_token_files(spark.createDataFrame([(1, "a")], SCHEMA), fresh(tmp_path), PATH, end_id=70_000)
