"""Token ids as packs of separately compressed documents under one shared dictionary.

A pack is a byte string::

    magic  version  bytes per id  documents  ids  dictionary hash   (header)
    frame  frame  frame …                                           (one zstandard frame each)
    offset  count    offset  count …                                (one index entry each)

so one document is read by its index entry, its frame and the dictionary alone. A
folder holds ``dictionary`` (its hash and bytes), ``packs`` (Parquet files whose rows are
packs, in the order of doc_id) and ``starts`` (ids before each range of packs). Spark commits these files,
so a task that is lost and run again leaves no half pack, on any store that Spark writes.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: documents from which the dictionary is trained, those with the smallest hash
SAMPLE_DOCS = 2_000
#: documents of up to so many characters are sampled: the dictionary is for short ones
SAMPLE_CHARS = 4_096
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: a pack is closed when its frames reach this size; a longer document is a pack by itself
PACK_BYTES = 4 << 20
#: pieces kept in a process with their ids, so that frequent words are encoded once
KEPT_PIECES = 1_000_000

_MAGIC, _VERSION = b"TPK1", 1
_HEADER = struct.Struct("<4sHHIQ32s")
_ENTRY = np.dtype([("offset", "<u8"), ("count", "<u8")])

Encoder = Callable[[str], np.ndarray]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def piece_encoder(path: str, kept: int = KEPT_PIECES) -> Encoder:
    """A function from a text to its ids, for byte-level tokenizers.

    Their split never joins a visible character to white space that follows it, nor a letter or
    digit to punctuation that follows it. So a text is cut before each space or line
    end after a visible character, and pieces are encoded once, without the punctuation at
    their ends. Ids of pieces are kept in the process, from task to task, in two halves of up to
    ``kept`` in all; when the newer is full it becomes the older, so memory is bounded.
    """
    if sys.byteorder != "little" or array("I").itemsize != 4:
        raise RuntimeError("ids are kept as this machine's own 32-bit numbers, low byte first")
    tokenizer, known, before = _tokenizer(path), {}, {}

    def learn(found: list[str]) -> dict[str, bytes]:
        whole, halves, ids = {}, {}, {}  # in the order found, each piece once
        for piece in found:
            if piece in before:
                ids[piece] = before[piece]
            elif piece[-1].isalnum():
                whole[piece] = None
            elif piece not in halves:
                stem = piece.rstrip(_PUNCTUATION)
                if stem and stem[-1].isalnum():
                    tail = piece[len(stem):]
                    halves[piece] = stem, tail
                    for half in (stem, tail):
                        if half in known:
                            ids[half] = known[half]
                        elif half in before:
                            ids[half] = before[half]
                        else:
                            whole[half] = None
                else:
                    whole[piece] = None
        for piece, e in zip(
                whole, tokenizer.encode_batch_fast(list(whole), add_special_tokens=False)):
            ids[piece] = array("I", e.ids).tobytes()
        for piece, (stem, tail) in halves.items():
            ids[piece] = ids[stem] + ids[tail]
        return ids

    def encode(text: str) -> np.ndarray:
        nonlocal known, before
        found = _cut(text) if text else []
        parts = list(map(known.get, found))
        if None in parts:
            missing = [k for k, ids in enumerate(parts) if ids is None]
            new = learn([found[k] for k in missing])
            for k in missing:
                parts[k] = new[found[k]]
            if len(known) + len(new) > kept // 2:
                before, known = known, {}
            if len(new) <= kept // 2:
                known.update(new)
        return np.frombuffer(b"".join(parts), "<u4")

    return encode


_PUNCTUATION = ".,;:!?*#$%&)"
_MARK = "\ue000\ue001"
_SPACE_BEFORE_CUT = re.compile(r"\s[ \n]")


def _cut(text: str) -> list[str]:
    """The text before each space or line end that follows a visible character."""
    if _MARK in text:
        return [text]
    cut = text.replace(" ", f"{_MARK} ").replace("\n", f"{_MARK}\n").split(_MARK)
    if not cut[0]:
        del cut[0]
    if not _SPACE_BEFORE_CUT.search(text):
        return cut
    joined: list[str] = []
    for piece in cut:
        if joined and joined[-1][-1].isspace():
            joined[-1] += piece
        else:
            joined.append(piece)
    return joined


def hash_of(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()


def pack(documents: list[np.ndarray], dictionary: bytes, width: int) -> bytes:
    """Documents' ids as one pack; ``width`` is 2 or 4 bytes per id."""
    dtype = f"<u{width}"
    compressor = _compressor(dictionary)
    frames = [compressor.compress(ids.astype(dtype).tobytes()) for ids in documents]
    return _assemble(frames, [len(ids) for ids in documents], dictionary, width)


def _assemble(frames: list[bytes], counts: list[int], dictionary: bytes, width: int) -> bytes:
    index = np.zeros(len(frames), _ENTRY)
    sizes = np.array([len(f) for f in frames], np.int64)
    index["offset"] = _HEADER.size + np.cumsum(sizes) - sizes
    index["count"] = counts
    header = _HEADER.pack(
        _MAGIC, _VERSION, width, len(frames), sum(counts), hash_of(dictionary))
    return b"".join([header, *frames, index.tobytes()])


@lru_cache(maxsize=2)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)


@lru_cache(maxsize=2)
def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=trained)


class Pack:
    """Read access to one pack: ``len(p)`` documents, ``p[k]`` the ids of one."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, version, self.width, self.documents, self.ids, digest = _HEADER.unpack_from(data)
        if magic != _MAGIC or version != _VERSION:
            raise ValueError("not a token pack of a known version")
        if digest != hash_of(dictionary):
            raise ValueError("the pack was written with another dictionary")
        self._data, self._dictionary = memoryview(data), dictionary
        self._end = len(data) - self.documents * _ENTRY.itemsize
        self._index = np.frombuffer(data, _ENTRY, offset=self._end)

    def __len__(self) -> int:
        return self.documents

    def __getitem__(self, k: int) -> np.ndarray:
        begin = int(self._index["offset"][k])
        end = int(self._index["offset"][k + 1]) if k + 1 < len(self) else self._end
        raw = _decompressor(self._dictionary).decompress(self._data[begin:end])
        ids = np.frombuffer(raw, f"<u{self.width}")
        if len(ids) != int(self._index["count"][k]):
            raise ValueError("the index and the frame disagree on the number of ids")
        return ids


def train_dictionary(docs: DataFrame, encode: Callable[[str], bytes]) -> bytes:
    """A dictionary from a bounded, reproducible sample; empty if the sample is too small.

    The sample is of distinct texts: those up to the hash of the SAMPLE_DOCS-th."""
    short = docs.where(F.length("text").between(1, SAMPLE_CHARS)).select(
        "text", F.xxhash64("text").alias("order"))
    # the hashes first, so that no task sends more texts than are sampled in all
    last = short.select("order").orderBy("order").limit(SAMPLE_DOCS).agg(F.max("order")).first()[0]
    sample = short.where(F.col("order") <= last).dropDuplicates(["order"]).collect()
    sample.sort(key=lambda row: row.order)
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, [encode(r.text) for r in sample])
    except zstandard.ZstdError:
        return b""
    return trained.as_bytes()


def write_token_files(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int, width: int = 2,
    pack_bytes: int = PACK_BYTES,
) -> None:
    """Encode the texts, append ``end_id`` to each, and write them in ascending doc_id order.

    A null text is one ``end_id``; a null doc_id comes first; rows of one doc_id are ordered by
    the hash of their text. Other columns are not read. ``width`` must hold every id of the tokenizer.
    Texts are sorted by range, with a salt as the last key, so that rows alike can be
    spread; each task then writes its range, holding one open pack.
    """
    spark = docs.sparkSession
    given = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    local = piece_encoder(tokenizer_file)
    dictionary = train_dictionary(given, lambda t: local(t).astype(f"<u{width}").tobytes())
    spark.createDataFrame(
        [(hash_of(dictionary).hex(), bytearray(dictionary))], "hash string, bytes binary"
    ).coalesce(1).write.parquet(f"{path}/dictionary")

    doc_id = given.schema["doc_id"].dataType

    def run(batches):
        encode = piece_encoder(tokenizer_file)
        compressor = _compressor(dictionary)
        part, before, most = TaskContext.get().partitionId(), 0, 256 ** width
        fits = max(end_id, max(_tokenizer(tokenizer_file).get_vocab().values())) < most
        stored, end = f"<u{width}", end_id.to_bytes(width if end_id < most else 8, "little")
        ids, frames, counts, size = [], [], [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "ids_before": pa.array([before], pa.int64()),
                "n_ids": pa.array([sum(counts)], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(arrow_id)),
                "pack": pa.array([_assemble(frames, counts, dictionary, width)], pa.binary())})

        for batch in batches:
            arrow_id = batch.schema.field("doc_id").type
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = encode(text.as_py())
                if not fits and found.max(initial=end_id) >= most:
                    raise ValueError(f"an id does not fit into {width} bytes")
                ids.append(key)
                frames.append(compressor.compress(found.astype(stored).tobytes() + end))
                counts.append(len(found) + 1)
                size += len(frames[-1])
                if size >= pack_bytes:
                    yield closed()
                    before += sum(counts)
                    ids, frames, counts, size = [], [], [], 0
        if ids:
            yield closed()

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (given.withColumn("_hash", F.xxhash64("text"))
     .withColumn("_salt", F.monotonically_increasing_id())
     .repartitionByRange(ranges, "doc_id", "_hash", "_salt")
     .sortWithinPartitions("doc_id", "_hash", "_salt").select("doc_id", "text")
     .mapInArrow(run, f"part int, ids_before bigint, n_ids bigint, "
                      f"doc_ids array<{doc_id.simpleString()}>, pack binary")
     .write.parquet(f"{path}/packs"))

    # one row per range, so bounded by the number of tasks
    total, starts = 0, []
    for part, n in sorted(spark.read.parquet(f"{path}/packs").groupBy("part")
                          .agg(F.sum("n_ids")).collect()):
        starts.append((part, total))
        total += n
    spark.createDataFrame(starts, "part int, ids_start bigint").coalesce(1).write.parquet(
        f"{path}/starts")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    """The folder's dictionary, checked against its hash."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["bytes"])
    if hash_of(dictionary).hex() != row["hash"]:
        raise ValueError("the dictionary does not have its hash")
    return dictionary


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32 and, if asked for, the ids.

    ``start`` is the number of ids of all documents before it; ``ids_crc32`` covers the
    ids as unsigned 32-bit little-endian integers. Each pack is read on its own.
    """
    dictionary = read_dictionary(spark, path)
    packs = spark.read.parquet(f"{path}/packs")
    starts = spark.read.parquet(f"{path}/starts")  # a row per range of the writing job
    given = packs.join(F.broadcast(starts), "part").select(
        (F.col("ids_start") + F.col("ids_before")).alias("start"), "doc_ids", "pack")
    doc_id = packs.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for k in range(batch.num_rows):
                packed = Pack(batch.column("pack")[k].as_py(), dictionary)
                found = [packed[i] for i in range(len(packed))]
                counts = np.array([len(x) for x in found], np.int64)
                columns = {
                    "doc_id": batch.column("doc_ids")[k].values,
                    "start": pa.array(
                        batch.column("start")[k].as_py() + np.cumsum(counts) - counts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_crc32": pa.array(
                        [zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64())}
                if ids:
                    columns["ids"] = pa.array([x.astype("<i8") for x in found],
                                              pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return given.mapInArrow(
        run, f"doc_id {doc_id}, start bigint, n_tokens bigint, ids_crc32 bigint"
             + (", ids array<bigint>" if ids else ""))


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents of one doc_id, by the offset index of the packs that hold it.

    Reads the key column of all packs, and the bytes of those with the key alone."""
    dictionary = read_dictionary(spark, path)
    holding = spark.read.parquet(f"{path}/packs").where(F.array_contains("doc_ids", doc_id))
    return [
        Pack(bytes(row["pack"]), dictionary)[k]
        for row in holding.select("doc_ids", "pack").toLocalIterator()
        for k, key in enumerate(row["doc_ids"]) if key == doc_id]
