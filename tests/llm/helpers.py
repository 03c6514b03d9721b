"""Small tables of documents, and plain versions of what the operators compute."""

import itertools
import re
import uuid

ASCII_LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id bigint, text string"


def stored(spark, tmp_path, rows, schema=SCHEMA, files=3):
    """The rows as Parquet files, read back."""
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


def fresh(tmp_path):
    return f"{tmp_path}/{uuid.uuid4().hex}"


def visible_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def gram_set(text, k):
    w = visible_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def linked_groups(sets, percent):
    """Of each set, the index of the first one reachable by links; all pairs are compared."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(sets))]
