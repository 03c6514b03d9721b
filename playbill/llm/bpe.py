"""Byte-level BPE by a rank file, through tiktoken."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

#: characters of a text from which it is cut before encoding
LONG = 1 << 16

# A cut here never falls inside a match of the split pattern, whatever stands on
# either side: no match goes on from a visible character into white space, and
# only a match of letters or of digits can hold two ASCII letters or digits.
_SAFE = re.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file: a base64 token and its rank on each line."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    """The text in pieces that encode to the same ids as the whole.

    A piece has about ``long`` characters, more only where no safe cut comes
    sooner, as in a long run of one kind of character.
    """
    begin = 0
    while len(text) - begin > long:
        cut = _SAFE.search(text, begin + long)
        if cut is None:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:]


def encode(text: str | None, rank_file: str, pattern: str, long: int = LONG) -> list[int]:
    """Ids of the whole text without special tokens; none for a null or empty text."""
    encoder = encoding(rank_file, pattern)
    if not text:
        return []
    if len(text) <= long:
        return encoder.encode_ordinary(text)
    return [i for piece in pieces(text, long) for i in encoder.encode_ordinary(piece)]


def decode(ids: list[int], rank_file: str, pattern: str) -> bytes:
    """The bytes of the ids, also where they end inside a character."""
    return encoding(rank_file, pattern).decode_bytes(ids)


def encode_texts(
    docs: DataFrame, rank_file: str, pattern: str, column: str = "text", out: str = "ids",
    long: int = LONG,
) -> DataFrame:
    """``docs`` with the ids of ``column`` in a new array column ``out``.

    Needs no shuffle: each row is encoded where it is read. A null text has no ids.
    ``out`` must not name a column of ``docs``. ``rank_file`` must lie at that path on
    every executor, as the files of an installed package do.
    """
    _must_be_new(docs, out)

    def run(batches):
        for batch in batches:
            texts = batch.column(column)
            ids = pa.array(
                (encode(t.as_py(), rank_file, pattern, long) for t in texts),
                pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, out])

    return docs.mapInArrow(run, _with(docs, f"`{out}` array<int>"))


def decode_ids(
    rows: DataFrame, rank_file: str, pattern: str, column: str = "ids", out: str = "bytes"
) -> DataFrame:
    """``rows`` with the bytes of the ids in ``column`` in a new binary column ``out``."""
    _must_be_new(rows, out)

    def run(batches):
        for batch in batches:
            data = pa.array(
                (decode(i.as_py() or [], rank_file, pattern) for i in batch.column(column)),
                pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, data], [*batch.schema.names, out])

    return rows.mapInArrow(run, _with(rows, f"`{out}` binary"))


def round_trip(
    docs: DataFrame, rank_file: str, pattern: str, long: int = LONG
) -> DataFrame:
    """Digests of encoding and decoding each text, made where the text is read.

    One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the decimal ids joined
    by a space), decoded_sha256, same (whether the text came back). A null text counts
    as empty. Other columns of ``docs`` are not read. Ids never leave the task, so nothing
    of their size is moved or stored.
    """
    spelled: list[bytes] = []

    def run(batches):
        if not spelled:
            spelled.extend(b"%d" % i for i in range(encoding(rank_file, pattern).n_vocab))
        for batch in batches:
            counts, ids_sha, text_sha, same = [], [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                ids = encode(text, rank_file, pattern, long)
                data = decode(ids, rank_file, pattern)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(b" ".join([spelled[i] for i in ids])).hexdigest())
                text_sha.append(hashlib.sha256(data).hexdigest())
                same.append(data == text.encode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same"])

    kept = docs.select("doc_id", "text")
    doc_id = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(
        run, f"doc_id {doc_id}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
             "same boolean")


def _must_be_new(df: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the frame already has a column {name}")


def _with(df: DataFrame, field: str) -> str:
    given = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join([*given, field])
