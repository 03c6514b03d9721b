"""Removal of long strings that occur more than once in a corpus, byte by byte.

Suffixes are sorted in blocks (``suffixes``); this module brings together what must meet in
one. Texts that are alike form a class first, then segments that are alike count once with their
number, so what is gathered are different segments around one anchor. An anchor with
more of them than a block holds is split into several; windows that are alone in
their block are then compared across these blocks by hash, which is as exact and moves a few bytes a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.arrow import fixed_filter, passing, slices, text_bytes
from playbill.llm.suffixes import LENGTH, RUN, repeated_windows, run_hashes, segments

#: bits of the filters by which segments and texts are fetched
FILTER_BITS = 23
#: bytes of segments sorted together, and bytes around one anchor from which they are split
BLOCK_BYTES = 512 << 10
HOT_BYTES = 1 << 20
#: anchors a task gathers before it passes them on
BUFFER = 1 << 18

_ANCHOR = np.dtype([("anchor", "<u8"), ("class", "<i8"), ("first", "<i8")])
_WINDOW = np.dtype([("hash", "<u8"), ("other", "<u8"), ("anchor", "<i8"), ("content", "<i8"),
                    ("at", "<i8")])


def class_of(text: bytes) -> tuple[int, str]:
    """A 64-bit number for all texts alike, and the SHA-256 it is taken from."""
    digest = hashlib.sha256(text)
    return int.from_bytes(digest.digest()[:8], "little", signed=True), digest.hexdigest()


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, begin = text_bytes(column)
    raw = data.tobytes()
    return (raw[a:b] for a, b in zip(begin[:-1], begin[1:]))


def profile(docs: DataFrame, carry: list[str], length: int, run: int, path: str) -> None:
    """Store each row's columns ``carry`` with size, class and digest of its text, and the anchors of
    all texts, packed by part; of each anchor two places are enough from a task."""
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    names = [*carry, "n_bytes", "class", "sha256", "part", "anchors"]

    def work(batches: Iterator[pa.RecordBatch]):
        seen: set[int] = set()
        gathered, size, types = [], 0, []

        def dealt() -> Iterator[pa.RecordBatch]:
            found = np.concatenate(gathered)
            found = found[np.argsort(found["anchor"], kind="stable")]
            third = np.zeros(len(found), bool)
            third[2:] = found["anchor"][2:] == found["anchor"][:-2]
            found = found[~third]
            part = found["anchor"] % np.uint64(parts)
            found = found[np.argsort(part, kind="stable")]
            number, begin = np.unique(np.sort(part), return_index=True)
            ends = np.append(begin[1:], len(found))
            n = len(number)
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(n, t) for t in types), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()),
                 pa.array(number.astype(np.int32)),
                 pa.array([found[a:b].tobytes() for a, b in zip(begin, ends)], pa.binary())], names)

        for batch in slices(batches, "text"):
            column = batch.column("text")
            types = [batch.schema.field(c).type for c in carry]
            data, begin = text_bytes(column)
            keys, digests = zip(*map(class_of, _texts(column)))
            new = np.zeros(len(keys), bool)
            for k, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    new[k] = True
            first, _, anchor, _ = segments(data, begin, length, run)
            text = np.searchsorted(begin, first, "right") - 1
            use = new[text]
            found = np.zeros(use.sum(), _ANCHOR)
            found["anchor"], found["first"] = anchor[use], (first - begin[text])[use]
            found["class"] = np.array(keys, np.int64)[text[use]]
            gathered.append(found)
            size += len(found)
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(np.diff(begin)),
                 pa.array(keys, pa.int64()), pa.array(digests, pa.string()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
            if size >= BUFFER:
                yield from dealt()
                gathered, size = [], 0
        if size:
            yield from dealt()

    docs.select(*carry, "text").mapInArrow(
        work, ", ".join([*fields, "n_bytes bigint, class bigint, sha256 string, part int, "
                                  "anchors binary"])).write.parquet(path)


def repeated_anchors(profiles: DataFrame) -> DataFrame:
    """Anchors that stand in two or more places, of one text or of several."""

    def several(table: pa.Table) -> pa.Table:
        found = np.concatenate([np.frombuffer(x.as_buffer(), _ANCHOR) for x in table["anchors"]])
        found = np.unique(found)
        again = found["anchor"][1:][found["anchor"][1:] == found["anchor"][:-1]]
        return pa.table({"anchor": pa.array(np.unique(again).view(np.int64), pa.int64())})

    return (profiles.where("part is not null").select("part", "anchors")
            .groupBy("part").applyInArrow(several, "anchor bigint"))


def fetched(docs: DataFrame, anchors: DataFrame, length: int, run: int, path: str) -> DataFrame:
    """Segments of repeated anchors: anchor, content (a hash), class, first window, windows, and
    their bytes where a task meets the content first."""
    spark = docs.sparkSession
    packed = spark.sparkContext.broadcast(fixed_filter(anchors, "anchor", FILTER_BITS))

    def work(batches: Iterator[pa.RecordBatch]):
        seen, contents = set(), set()
        for batch in slices(batches, "text"):
            column = batch.column("text")
            data, begin = text_bytes(column)
            first, last, anchor, place = segments(data, begin, length, run)
            use = passing(packed.value, FILTER_BITS, anchor.view(np.int64))
            text = np.searchsorted(begin, first, "right") - 1
            keys = [class_of(t)[0] for t in _texts(column)]
            new = np.array([k not in seen for k in keys], bool)
            # of texts alike in one slice, the first
            later = np.ones(len(keys), bool)
            later[np.unique(np.array(keys, np.int64), return_index=True)[1]] = False
            new[later] = False
            seen.update(keys)
            use &= new[text]
            if not use.any():
                continue
            raw, rows = data.tobytes(), []
            for a, b, h, p, t in zip(first[use].tolist(), last[use].tolist(),
                                     anchor[use].view(np.int64).tolist(), place[use].tolist(),
                                     text[use].tolist()):
                part = raw[a:b + length]
                content = xxhash.xxh64_intdigest(part, seed=p - a) - (1 << 63)
                known = (h, content) in contents
                contents.add((h, content))
                rows.append((h, content, keys[t], a - int(begin[t]), b - a + 1,
                             None if known else part))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in list(zip(*rows))[:5]),
                 pa.array([r[5] for r in rows], pa.binary())],
                ["anchor", "content", "class", "first", "windows", "bytes"])

    docs.select("text").mapInArrow(
        work, "anchor bigint, content bigint, class bigint, first bigint, windows bigint, "
              "bytes binary").write.parquet(path)
    return spark.read.parquet(path)


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def sorted_blocks(contents: DataFrame, length: int, routes: int) -> DataFrame:
    """Sort the suffixes of each block: the runs of repeated windows of each content.

    ``contents`` has block, anchor, content, bytes and split (whether the anchor fills several blocks). Rows
    with a route are windows of split anchors, packed, to be compared across blocks: all
    that are alone in their block, and one for each that is not.
    """

    def work(table: pa.Table) -> pa.Table:
        parts = [x.as_py() for x in table["bytes"]]
        anchors, names = table["anchor"].to_pylist(), table["content"].to_pylist()
        split = table["split"].to_pylist()
        flags = repeated_windows(parts, length)
        rows = [
            (a, c, first, last, None, None)
            for a, c, f in zip(anchors, names, flags) for first, last in _runs(f)]
        windows = []
        for part, a, c, f, s in zip(parts, anchors, names, flags, split):
            if not s or not len(f):
                continue
            data = np.frombuffer(part, np.uint8)
            found = np.zeros(len(f), _WINDOW)
            found["hash"] = run_hashes(data, length)[:len(f)]
            found["other"] = run_hashes(data ^ np.uint8(0x55), length)[:len(f)]
            found["anchor"], found["content"] = a, c
            found["at"] = np.where(f, -1, np.arange(len(f)))
            windows.append(found)
        if windows:
            found = np.concatenate(windows)
            found = found[np.lexsort((found["at"], found["other"], found["hash"]))]
            new = np.ones(len(found), bool)
            new[1:] = (found["hash"][1:] != found["hash"][:-1]) | (
                found["other"][1:] != found["other"][:-1])
            found = found[new]
            route = (found["hash"] % np.uint64(routes)).astype(np.int64)
            for number in np.unique(route):
                rows.append((None, None, None, None, int(number), found[route == number].tobytes()))
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
        columns = list(zip(*rows)) or [()] * 6
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds)],
                        ["anchor", "content", "from", "to", "route", "windows"])

    return contents.groupBy("block").applyInArrow(
        work, "anchor bigint, content bigint, from bigint, to bigint, route int, windows binary")


def across_blocks(found: DataFrame) -> DataFrame:
    """Windows alone in their block that another block of the same anchor has too."""

    def work(table: pa.Table) -> pa.Table:
        w = np.concatenate([np.frombuffer(x.as_buffer(), _WINDOW) for x in table["windows"]])
        w = w[np.lexsort((w["other"], w["hash"]))]
        same = (w["hash"][1:] == w["hash"][:-1]) & (w["other"][1:] == w["other"][:-1])
        again = np.zeros(len(w), bool)
        again[1:] |= same
        again[:-1] |= same
        w = w[again & (w["at"] >= 0)]
        return pa.table([pa.array(w[c].copy()) for c in ("anchor", "content", "at", "at")],
                        ["anchor", "content", "from", "to"])

    return (found.where("route is not null").select("route", "windows").groupBy("route")
            .applyInArrow(work, "anchor bigint, content bigint, from bigint, to bigint"))


def repeated_runs(stored: DataFrame, length: int, work: str) -> DataFrame:
    """Runs of repeated windows (from, to) in contents: those of every content that
    has two members, and those that sorting finds between contents of one anchor."""
    spark = stored.sparkSession
    members = stored.select("anchor", "content", "class", "first", "windows").distinct()
    per_content = members.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("n"), F.first("windows").alias("windows"))
    per_content.write.parquet(f"{work}/contents")
    per_content = spark.read.parquet(f"{work}/contents")
    per_anchor = per_content.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.col("windows") + length - 1).alias("size")).where("k > 1")
    total = per_anchor.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    block = F.when(
        F.col("size") < HOT_BYTES, F.pmod(F.xxhash64("anchor"), F.lit(blocks))
    ).otherwise(F.xxhash64(
        "anchor", F.pmod("content", F.ceil(F.col("size") / HOT_BYTES))))
    contents = (
        stored.where("bytes is not null").select("anchor", "content", "bytes")
        .join(per_anchor.select("anchor", "size"), "anchor")
        .dropDuplicates(["anchor", "content"])
        .select(block.alias("block"), "anchor", "content", "bytes",
                (F.col("size") >= HOT_BYTES).alias("split")))
    routes = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_blocks(contents, length, routes).write.parquet(f"{work}/sorted")
    found = spark.read.parquet(f"{work}/sorted")
    whole = per_content.where("n > 1").select(
        "anchor", "content", F.lit(0).cast("bigint").alias("from"),
        (F.col("windows") - 1).alias("to"))
    return (found.where("route is null").select("anchor", "content", "from", "to")
            .unionAll(across_blocks(found)).unionAll(whole))


_SPANS = "array<struct<begin:bigint,end:bigint>>"


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    result: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if result and begin <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((begin, end))
    return result


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Of each class with spans: class, n_removed, n_spans, kept_sha256 and merged spans.

    ``spans`` has class and the list of its spans, one row each. Texts of other classes are not moved.
    """
    packed = docs.sparkSession.sparkContext.broadcast(fixed_filter(spans, "class", FILTER_BITS))

    def wanted(batches: Iterator[pa.RecordBatch]):
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            rows = []
            for text in _texts(batch.column("text")):
                key, _ = class_of(text)
                if key not in seen and passing(packed.value, FILTER_BITS, np.array([key]))[0]:
                    seen.add(key)
                    rows.append((key, text))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.binary())], ["class", "text"])

    def removed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for key, text, found in zip(*(batch.column(c) for c in ("class", "text", "spans"))):
                runs = merged([(s["begin"], s["end"]) for s in found.as_py()])
                raw, kept, at = text.as_py(), hashlib.sha256(), 0
                for begin, end in runs:
                    kept.update(raw[at:begin])
                    at = end
                kept.update(raw[at:])
                rows.append({
                    "class": key.as_py(), "n_removed": sum(e - b for b, e in runs),
                    "n_spans": len(runs), "kept_sha256": kept.hexdigest(),
                    "spans": [{"begin": b, "end": e} for b, e in runs]})
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    texts = docs.select("text").mapInArrow(wanted, "class bigint, text binary")
    return texts.join(spans, "class").mapInArrow(
        removed, "class bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                 f"spans {_SPANS}").dropDuplicates(["class"])


def remove_repeats(
    docs: DataFrame, work: str, length: int = LENGTH, run: int = RUN,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """What stays of each text without the bytes in any string of ``length`` bytes that starts elsewhere too.

    One row per row of ``docs``: the columns ``carry``, n_bytes, n_removed, n_spans,
    kept_sha256 and spans (removed runs of bytes). Texts that occur twice are removed whole if they have ``length`` bytes,
    every copy of them; a null text counts as empty; matches never cross texts. ``run`` must be less than
    ``length``. Strings and texts alike are told by 64-bit hashes with their anchor's. ``work`` is
    an unused folder that all executors share.
    """
    spark, keep = docs.sparkSession, list(carry)
    profile(docs, keep, length, run, f"{work}/profiles")
    profiles = spark.read.parquet(f"{work}/profiles")
    anchors = repeated_anchors(profiles)
    stored = fetched(docs, anchors, length, run, f"{work}/segments")
    runs = repeated_runs(stored, length, work)
    members = stored.select("anchor", "content", "class", "first").distinct()
    spans = members.join(runs, ["anchor", "content"]).select(
        "class", F.struct((F.col("first") + F.col("from")).alias("begin"),
                          (F.col("first") + F.col("to") + length).alias("end")).alias("span"))
    rows = profiles.where("part is null").drop("part", "anchors")
    copies = rows.groupBy("class").agg(F.count(F.lit(1)).alias("copies"))
    single = copies.where("copies = 1").select("class")
    spans.join(single, "class", "left_semi").groupBy("class").agg(
        F.collect_list("span").alias("spans")).write.parquet(f"{work}/spans")
    results = cut(docs, spark.read.parquet(f"{work}/spans"))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    none = F.array().cast(_SPANS)
    all_of_it = F.array(F.struct(F.lit(0).cast("bigint").alias("begin"), F.col("n_bytes").alias("end")))
    return rows.join(copies.where("copies > 1"), "class", "left").join(results, "class", "left").select(
        *keep, "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256().hexdigest()))
        .otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(whole, all_of_it).otherwise(F.coalesce("spans", none)).alias("spans"))
