"""N-gram Jaccard join with adaptive multi-match prefixes.

Each document is a set of word n-grams under one global order, frequent ones last. Two sets of
which at least ``o`` members are common share at least ``k`` of the first ``size - o + k`` of each.
A document takes such a prefix for a ``k`` of its own, the larger the more its
candidates are expected to cost, and a pair is verified only if it shares as many prefix
members as the smaller ``k`` of the two. The result is exact for every order and ``k``.

Sets that are equal form a class first. Members of prefixes that no second class has are dropped
where they meet, then classes left with too few; the others are stored one row each, with their
shared members and a signature. Each group of near copies is then linked through one of its own, so
that no group's pairs are all listed, and only pairs that this leaves in different components
are joined by their prefix members. Two exact bounds hold inside these joins, before any set moves:

* the signature flips one of its bits for each member, so sets whose signatures differ in ``d`` bits
  differ in ``d`` members at least;
* two sets share no more than the members their prefixes share and what follows the prefix that
  ends first.

Sets of pairs that pass are fetched by the place of one of their documents, file and row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.arrow import fixed_filter, passing, slices, summed, text_bytes
from playbill.llm.components import components
from playbill.llm.words import VISIBLE, mixed, runs, words

#: counters of the frequency sketch; its size does not depend on the data
SKETCH_BITS = 20
#: bytes of postings that a group of members has, on average
PART_BYTES = 2 << 20
#: estimated documents for each salt of a member: its postings are dealt out by class to as many
#: groups as it has salts, so that no group grows with the frequency of a member
SALT = 20_000
#: least members by which a class looks for the centre of its group
CENTRE_MEMBERS = 16
#: numbers of 64 bits in a signature
SIGNATURE = 8
#: bits of the filter for each place of a set that is fetched, and of all at most
FILTER_BITS, MOST_FILTER_BITS = 32, 26
#: postings a task gathers before it passes them on
BUFFER = 1 << 18
_BLOCK = 1 << 14


@dataclass(frozen=True)
class Similarity:
    """Words per n-gram, and the least similarity in percent."""

    words: int = 5
    percent: int = 80

    def least_common(self, size):
        """Members that a set of ``size`` shares with any set similar to it."""
        return (self.percent * size + 99) // 100

    def least_matches(self, size):
        """The least ``k``: a sixteenth of the set, and one at least."""
        return size // 16 + (size < 16)

    def similar(self, size, other, common):
        """Whether sets of these sizes with so many common members are similar."""
        return 100 * common >= self.percent * (size + other - common)

    # the same in SQL, for rows with size, length, matches and signature of two sides

    def sizes_fit(self, a: str = "a_size", b: str = "b_size") -> str:
        return f"100 * least({a}, {b}) >= {self.percent} * greatest({a}, {b})"

    def differences_fit(self, differences: str, size: str) -> str:
        """Sets that differ in so many members and have ``size`` of both together."""
        return f"{100 - self.percent} * ({size}) >= {100 + self.percent} * ({differences})"

    def matches_fit(self, matches: str) -> str:
        """Sets that share so many prefix members: what they must have in common is no more than
        these and what follows one of the prefixes."""
        needed = (f"({self.percent} * (a_size + b_size) + {99 + self.percent}) "
                  f"div {100 + self.percent}")
        return (f"{matches} >= {needed} "
                "- greatest(a_size - a_length, b_size - b_length)")


def signature(members: np.ndarray) -> np.ndarray:
    """The parities of the members that fall to each of 64 * SIGNATURE bits."""
    bit = (mixed(members ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(64 * SIGNATURE)).astype(np.int64)
    flips = np.bincount(bit, minlength=64 * SIGNATURE).astype(np.uint8) & 1
    return np.packbits(flips).view(np.int64)


SIGNS = [f"s{k}" for k in range(SIGNATURE)]
_FACTS = ["class", "size", "length", "matches", *SIGNS]
#: SQL: in how many bits the signatures of two sides differ
_DIFFERENCES = " + ".join(f"bit_count(a_{s} ^ b_{s})" for s in SIGNS)


def sets(column: pa.Array, words_each: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct n-grams of each text; of fewer words, one of all."""
    found = words(*text_bytes(column), VISIBLE)
    grams = runs(found.hash, words_each)
    result = []
    for begin, end in zip(found.first[:-1], found.first[1:]):
        if end - begin >= words_each:
            result.append(np.unique(grams[begin:end - words_each + 1]))
        elif end > begin:
            result.append(runs(found.hash[begin:end], int(end - begin)))
        else:
            result.append(np.zeros(0, np.uint64))
    return result


def class_key(members: np.ndarray) -> int:
    """A 64-bit hash of the whole set."""
    folded = np.array([
        np.bitwise_xor.reduce(mixed(members ^ np.uint64(0x5851F42D4C957F2D))),
        np.add.reduce(members * np.uint64(0xD1342543DE82EF95)), len(members)], np.uint64)
    return int(mixed(folded.sum(keepdims=True)).view(np.int64)[0])


def _buckets(members: np.ndarray) -> np.ndarray:
    return (members >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def profile(docs: DataFrame, carry: list[str], like: Similarity, path: str) -> None:
    """Store, in one pass, each document's columns ``carry`` with size and class of its set, and
    each task's part of the frequency sketch."""
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]

    def run(batches: Iterator[pa.RecordBatch]):
        counts, types = np.zeros(1 << SKETCH_BITS, np.int64), None
        for batch in slices(batches, "text"):
            types = [batch.schema.field(c).type for c in carry]
            found = sets(batch.column("text"), like.words)
            if any(map(len, found)):
                counts += np.bincount(_buckets(np.concatenate(found)), minlength=len(counts))
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry),
                 pa.array([len(s) for s in found], pa.int64()),
                 pa.array([class_key(s) if len(s) else None for s in found], pa.int64()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                [*carry, "size", "class", "part", "block", "counts"])
        blocks = [k for k in range(0, len(counts), _BLOCK) if counts[k:k + _BLOCK].any()]
        if blocks:
            n = len(blocks)
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(n, t) for t in types), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()),
                 pa.array([TaskContext.get().partitionId()] * n, pa.int32()),
                 pa.array([k // _BLOCK for k in blocks], pa.int32()),
                 pa.array([counts[k:k + _BLOCK].tobytes() for k in blocks])],
                [*carry, "size", "class", "part", "block", "counts"])

    docs.select(*carry, "text").mapInArrow(
        run, ", ".join([*fields, "size bigint, class bigint, part int, block int, counts binary"])
    ).write.parquet(path)


def sketch(profiles: DataFrame) -> np.ndarray:
    """How many documents have members of each bucket; tasks' parts are added up by block."""

    blocks = summed(profiles.where("block is not null").select("part", "block", "counts"), ["block"])
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in blocks.collect():  # as many as the sketch has blocks
        counts[row.block * _BLOCK:(row.block + 1) * _BLOCK] = np.frombuffer(row.counts, np.int64)
    return counts


def partners(counts: np.ndarray) -> np.ndarray:
    """Expected other documents per member, by bucket: what stands out of the sketch's noise.

    Where nothing does, a tenth of a document, so that longer prefixes are never free.
    """
    noise = float(np.median(counts))
    return np.maximum(counts - noise - 4 * noise ** 0.5 - 1, 0.1)


def ordered(members: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """The set in the global order: by expected partners, then by hash."""
    return members[np.lexsort((members, expected[_buckets(members)]))]


def prefix(members: np.ndarray, expected: np.ndarray, like: Similarity) -> tuple[int, int]:
    """Length of an ordered set's prefix, and the matches it asks for.

    A candidate with k matches takes k of the S postings met by the prefix, so there are
    S / k at most. Each posting costs one, met or its own, each candidate the reading of its set, as
    many as a posting is to the set's bytes. The k of least cost is taken, between the least and
    four times that.
    """
    size = len(members)
    common, least = like.least_common(size), like.least_matches(size)
    most = min(4 * least, common)
    least = min(least, most)
    met = np.cumsum(expected[_buckets(members[:size - common + most])])
    k = np.arange(least, most + 1)
    met = met[size - common + k - 1]
    matches = int(k[np.argmin(size - common + k + met * (1 + size / 2 / k))])
    return size - common + matches, matches


def postings(
    docs: DataFrame, expected: np.ndarray, like: Similarity, parts: int, path: str
) -> None:
    """Store the members of prefixes that two or more classes have, and a row per class.

    A posting has member and class, two numbers; the row of a class has no member but ``about``: its
    size, length (of its prefix), matches and signature. Tasks pass on packed arrays, one per group of
    members, so the shuffle moves 12 bytes a posting: the group and half of the member's hash tell it, and
    where two members share both, the classes only look more alike than they are. A group sorts its members
    and drops what only one class has. Members with several salts are certainly shared.
    """
    given = docs.sparkSession.sparkContext.broadcast(expected)  # 2 ** SKETCH_BITS numbers
    width = 4 + SIGNATURE

    def run(batches: Iterator[pa.RecordBatch]):
        seen: set[int] = set()
        member, key, about, size = [], [], [], 0
        estimates = given.value

        def packed(part: np.ndarray, salt: np.ndarray, members: np.ndarray, classes: np.ndarray):
            order = np.lexsort((salt, part))
            part, salt, members, classes = (x[order] for x in (part, salt, members, classes))
            new = np.ones(len(part), bool)
            new[1:] = (part[1:] != part[:-1]) | (salt[1:] != salt[:-1])
            begin = np.flatnonzero(new)
            ends = np.append(begin[1:], len(part))
            return pa.RecordBatch.from_pydict({
                "part": pa.array(part[begin], pa.int32()), "salt": pa.array(salt[begin], pa.int32()),
                "members": pa.array([members[b:e].tobytes() for b, e in zip(begin, ends)], pa.binary()),
                "classes": pa.array([classes[b:e].tobytes() for b, e in zip(begin, ends)], pa.binary())})

        def dealt() -> Iterator[pa.RecordBatch]:
            facts = np.array(about, np.int64)
            home = (facts[:, 0].view(np.uint64) % np.uint64(parts)).astype(np.int64)
            yield packed(home, np.full(len(home), -1), np.zeros(len(home), np.uint32), facts)
            m, c = np.concatenate(member), np.concatenate(key)
            salts = (1 + estimates[_buckets(m)] // SALT).astype(np.uint64)
            salt = np.where(salts > 1, 1 + (c.view(np.uint64) % salts).astype(np.int64), 0)
            yield packed((m % np.uint64(parts)).astype(np.int64), salt,
                         (m >> np.uint64(32)).astype(np.uint32), c)

        for batch in slices(batches, "text"):
            for found in sets(batch.column("text"), like.words):
                if not len(found):
                    continue
                own = class_key(found)
                if own in seen:
                    continue
                seen.add(own)
                found = ordered(found, estimates)
                length, matches = prefix(found, estimates, like)
                about.append((own, len(found), length, matches, *signature(found).tolist()))
                member.append(found[:length])
                key.append(np.full(length, own, np.int64))
                size += length
            if size >= BUFFER:
                yield from dealt()
                member, key, about, size = [], [], [], 0
        if size:
            yield from dealt()

    def shared(table: pa.Table) -> pa.Table:
        part, salt = table["part"][0].as_py(), table["salt"][0].as_py()
        c = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table["classes"]])
        if salt < 0:
            facts = c.reshape(-1, width)
            facts = facts[np.unique(facts[:, 0], return_index=True)[1]]
            about = pa.ListArray.from_arrays(
                pa.array(np.arange(len(facts) + 1) * (width - 1), pa.int32()),
                pa.array(facts[:, 1:].ravel()))
            return pa.table([pa.nulls(len(facts), pa.int64()), pa.array(facts[:, 0].copy()), about],
                            ["member", "class", "about"])
        m = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["members"]])
        order = np.lexsort((c, m))
        m, c = m[order], c[order]
        new = np.ones(len(m), bool)
        new[1:] = (m[1:] != m[:-1]) | (c[1:] != c[:-1])
        m, c = m[new], c[new]
        if salt == 0:
            first = np.ones(len(m) + 1, bool)
            first[1:-1] = m[1:] != m[:-1]
            alone = first[:-1] & first[1:]
            m, c = m[~alone], c[~alone]
        return pa.table([pa.array(m.astype(np.int64) * parts + part), pa.array(c),
                         pa.nulls(len(m), pa.list_(pa.int64()))], ["member", "class", "about"])

    (docs.select("text")
     .mapInArrow(run, "part int, salt int, members binary, classes binary")
     .groupBy("part", "salt").applyInArrow(
         shared, "member bigint, class bigint, about array<bigint>")
     .write.parquet(path))


def class_rows(stored: DataFrame, like: Similarity, path: str) -> DataFrame:
    """A row for each class that may have links: class, size, length, matches, signature, members.

    ``members`` are those of its prefix that other classes have in theirs. A class with fewer than the
    least matches of the smallest set similar to it has no links.
    """
    facts = stored.where("member is null").select(
        "class", *(F.col("about")[k].alias(name) for k, name in enumerate(_FACTS[1:])))
    (stored.where("member is not null").groupBy("class")
     .agg(F.collect_list("member").alias("members")).join(facts, "class")
     .withColumn("smallest", F.expr(f"({like.percent} * size + 99) div 100"))
     .where("size(members) >= smallest div 16 + if(smallest < 16, 1, 0)")
     .select(*_FACTS, "members").write.parquet(path))
    return stored.sparkSession.read.parquet(path)


def _sided(classes: DataFrame, side: str) -> DataFrame:
    return classes.select(*(F.col(c).alias(f"{side}_{c}") for c in _FACTS))


def through_centres(classes: DataFrame, like: Similarity) -> DataFrame:
    """Pairs (a, b) of each class with a few centres, those of its least members.

    The centre of a member is the class with most shared prefix members for its prefix, which in a group of
    near copies is one that is little changed, and near copies have most of their least
    members in common. So there are CENTRE_MEMBERS pairs a class at most.
    """
    asking = classes.select(
        "class", F.expr("length - size(members)").alias("changed"),
        F.explode(F.expr(f"slice(array_sort(members), 1, {CENTRE_MEMBERS})")).alias("member"))
    centre = asking.groupBy("member").agg(
        F.min(F.struct("changed", "class")).alias("centre")).select("member", "centre.class")
    pairs = (
        asking.select("member", F.col("class").alias("a"))
        .join(centre.withColumnRenamed("class", "b"), "member").where("a <> b")
        .select(F.least("a", "b").alias("a_class"), F.greatest("a", "b").alias("b_class"))
        .distinct())
    return (
        pairs.join(_sided(classes, "a"), "a_class").join(_sided(classes, "b"), "b_class")
        .where(f"{like.sizes_fit()} and {like.differences_fit(_DIFFERENCES, 'a_size + b_size')}")
        .select(F.col("a_class").alias("a"), F.col("b_class").alias("b")))


def across(classes: DataFrame, labels: DataFrame, like: Similarity, work: str) -> DataFrame:
    """Pairs (a, b) of classes in different components that may be similar.

    A class shares prefix members with a component first: it is paired with those of the
    component's classes only if these members are as many as one of them needs. So the
    members that a group of near copies has in common are met once for each class, not for each
    pair. Bits in which all of a component's classes that have the member agree bound the
    differences to any of them. Of two components the one with fewer classes asks.
    """
    spark = classes.sparkSession
    labelled = classes.join(labels, F.col("class") == F.col("node"), "left").select(
        *_FACTS, F.coalesce("component", "class").alias("label"), "members")
    met = labelled.select("class", "label", F.explode("members").alias("member"))
    several = met.groupBy("member").agg(
        F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
    met.join(several.select("member"), "member").write.parquet(f"{work}/met")
    met = spark.read.parquet(f"{work}/met")
    # from here on only classes that share members with another component
    concerned = met.select("class").distinct()
    info = labelled.drop("members").join(concerned, "class")
    weights = info.groupBy("label").agg(F.count(F.lit(1)).alias("weight"))
    info.join(weights, "label").write.parquet(f"{work}/concerned")
    info = spark.read.parquet(f"{work}/concerned")
    met = met.select("member", "class").join(info, "class")
    asking = met.select("member", "label", "weight", *(F.col(c).alias(f"a_{c}") for c in _FACTS))
    asked = met.groupBy("member", F.col("label").alias("b_label")).agg(
        F.first("weight").alias("b_weight"), F.min("size").alias("least_size"),
        F.max("size").alias("most_size"), F.min("matches").alias("b_matches"),
        *(F.bit_and(s).alias(f"and_{s}") for s in SIGNS),
        *(F.bit_or(s).alias(f"or_{s}") for s in SIGNS))
    agreed = " + ".join(
        f"bit_count((a_{s} & ~or_{s}) | (~a_{s} & and_{s}))" for s in SIGNS)
    near = (
        asking.join(asked, "member")
        .where("struct(weight, label) < struct(b_weight, b_label) "
               f"and 100 * a_size >= {like.percent} * least_size "
               f"and 100 * most_size >= {like.percent} * a_size "
               f"and {like.differences_fit(agreed, 'a_size + most_size')}")
        .groupBy("a_class", "a_matches", "b_label")
        .agg(F.count(F.lit(1)).alias("n"), F.min("b_matches").alias("b_matches"))
        .where("n >= least(a_matches, b_matches)").select("a_class", "b_label", "n"))
    others = info.select(F.col("label").alias("b_label"), *(F.col(c).alias(f"b_{c}") for c in _FACTS))
    return (
        near.join(_sided(info, "a"), "a_class").join(others, "b_label")
        .where(f"{like.sizes_fit()} and {like.matches_fit('n')} and n >= least(a_matches, b_matches) "
               f"and {like.differences_fit(_DIFFERENCES, 'a_size + b_size')}")
        .select(F.col("a_class").alias("a"), F.col("b_class").alias("b")))


def fetched(
    docs: DataFrame, profiles: DataFrame, pairs: DataFrame, expected: np.ndarray,
    like: Similarity, work: str,
) -> DataFrame:
    """The ordered sets of the classes in ``pairs``: class, length, matches, members (packed).

    A class is read from the first of its documents by file and row. A filter tells tasks which rows to
    send; it has FILTER_BITS bits for each up to 2 ** MOST_FILTER_BITS in all. Rows that it lets
    pass by chance, the more the fuller it is, find no partner in the join by file and row.
    """
    spark = docs.sparkSession
    classes = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    (profiles.join(classes, "class").groupBy("class")
     .agg(F.min(F.struct("_file", "_row")).alias("place")).select("class", "place.*")
     .write.parquet(f"{work}/places"))
    places = spark.read.parquet(f"{work}/places")
    key = F.xxhash64("_file", "_row").alias("key")
    bits = min(max(places.count() * FILTER_BITS, 1 << 15).bit_length(), MOST_FILTER_BITS)
    wanted = spark.sparkContext.broadcast(fixed_filter(places.select(key), "key", bits))
    given = spark.sparkContext.broadcast(expected)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            batch = batch.filter(pa.array(
                passing(wanted.value, bits, batch.column("key").to_numpy()), pa.bool_()))
            for part in slices(iter([batch]), "text"):
                rows = []
                for members in sets(part.column("text"), like.words):
                    members = ordered(members, given.value)
                    facts = prefix(members, given.value, like) if len(members) else (0, 0)
                    rows.append((*facts, members.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_file"), part.column("_row"), *map(pa.array, zip(*rows))],
                    ["_file", "_row", "length", "matches", "members"])

    schema = "_file string, _row bigint, length bigint, matches bigint, members binary"
    (docs.select("_file", "_row", key, "text").mapInArrow(run, schema)
     .join(places, ["_file", "_row"]).drop("_file", "_row").write.parquet(f"{work}/sets"))
    return spark.read.parquet(f"{work}/sets")


def verified(pairs: DataFrame, found: DataFrame, like: Similarity) -> DataFrame:
    """The pairs (a, b) of classes that are similar, by their sets."""
    for side in ("a", "b"):
        pairs = pairs.join(found.select(
            F.col("class").alias(side),
            *(F.col(c).alias(f"{side}_{c}") for c in ("members", "length", "matches"))), side)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keep = []
            columns = [batch.column(f"{s}_{c}") for s in "ab" for c in ("members", "length", "matches")]
            for am, al, ak, bm, bl, bk in zip(*columns):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (am, bm))
                matches = np.intersect1d(a[:al.as_py()], b[:bl.as_py()], assume_unique=True)
                if len(matches) < min(ak.as_py(), bk.as_py()):
                    keep.append(False)
                    continue
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(like.similar(len(a), len(b), common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def similar(
    docs: DataFrame, work: str, like: Similarity = Similarity(), carry: tuple[str, ...] = ("doc_id",),
    places: bool = False,
) -> DataFrame:
    """The columns ``carry`` of each row of ``docs``, a frame read from files, with set and component.

    Further columns: size (of the set), class (equal sets share it; null for none), and first, a struct of ``carry``: the
    least row of the component by these columns, nulls last. ``places`` adds _file and _row, the place
    of the row, to both. A null text, or one without
    words, has size 0 and is its own component, as is every document without links. Texts
    and n-grams are told apart by 64-bit hashes. Other columns of ``docs`` are not read.
    ``work`` is an unused folder that all executors share.
    """
    spark, keep = docs.sparkSession, list(carry)
    metadata = docs.metadataColumn("_metadata")
    located = docs.select(*keep, "text", metadata["file_path"].alias("_file"),
                          metadata["row_index"].alias("_row"))
    profile(located, [*keep, "_file", "_row"], like, f"{work}/profiles")
    keep += ["_file", "_row"] if places else []
    profiles = spark.read.parquet(f"{work}/profiles")
    expected = partners(sketch(profiles))
    prefixes = profiles.agg(F.sum("size")).first()[0] or 0
    parts = 1 + prefixes * 12 // 4 // PART_BYTES
    postings(docs, expected, like, parts, f"{work}/postings")
    classes = class_rows(spark.read.parquet(f"{work}/postings"), like, f"{work}/classes")

    def linked(pairs: DataFrame, number: int) -> DataFrame:
        """The links among the pairs."""
        pairs.write.parquet(f"{work}/pairs-{number}")
        pairs = spark.read.parquet(f"{work}/pairs-{number}")
        found = fetched(located, profiles, pairs, expected, like, f"{work}/{number}")
        verified(pairs, found, like).write.parquet(f"{work}/links-{number}")
        return spark.read.parquet(f"{work}/links-{number}")

    labels = components(linked(through_centres(classes, like), 0), f"{work}/components-0")
    more = linked(across(classes, labels, like, work), 1)
    joined = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more)
    labels = components(joined, f"{work}/components-1")

    rows = profiles.where("block is null").select(*keep, "size", "class")
    order = F.struct(*(x for c in keep for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))))
    classes = (
        rows.where("class is not null").groupBy("class").agg(F.min(order).alias("first"))
        .join(labels, F.col("class") == F.col("node"), "left")
        .select("class", "first", F.coalesce("component", "class").alias("label")))
    firsts = classes.groupBy("label").agg(F.min("first").alias("first"))
    named = classes.select("class", "label").join(firsts, "label").select("class", "first")
    own = F.struct(*keep)
    return rows.join(named, "class", "left").select(
        *keep, "size", "class",
        F.when(F.col("first").isNull(), own)
        .otherwise(F.struct(*(F.col(f"first.{c}").alias(c) for c in keep))).alias("first"))


def keep_one(docs: DataFrame, work: str, like: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs``, a frame read from files, without near copies: the least doc_id of each
    component stays, all its columns with it."""
    metadata = docs.metadataColumn("_metadata")
    kept = similar(docs, work, like, ("doc_id",), True).where(
        "_file = first._file and _row = first._row").select("_file", "_row")
    return docs.join(
        kept, (metadata["file_path"] == kept["_file"]) & (metadata["row_index"] == kept["_row"]),
        "left_semi")
