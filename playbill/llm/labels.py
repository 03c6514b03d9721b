"""Bounded samples of labelled documents, from which classifiers learn."""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int
) -> tuple[DataFrame, float]:
    """At most about ``rows`` documents of each label (0 or 1): doc_id, text, label.

    Those with the smallest hash of doc_id are taken; the cut follows from the number of
    labels, so every task chooses for itself. Only the chosen identifiers, a bounded
    number, are sent to where the documents are, and the texts of no others are moved. A doc_id that occurs several
    times counts once, with its greatest label; one that is null, and null texts, are left out. Also
    returned: what taking a smaller share of one label adds to the logarithm of the odds.
    """
    given = (
        labels.where(f"{label} in (0, 1) and doc_id is not null").groupBy("doc_id")
        .agg(F.max(label).cast("bigint").alias(label)))
    counts = dict(given.groupBy(label).count().collect())
    share = {k: min(1.0, rows / max(counts.get(k, 0), 1)) for k in (0, 1)}
    position = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    chosen = given.where(position < F.when(F.col(label) == 1, share[1]).otherwise(share[0]))
    found = (
        docs.select("doc_id", "text").where("text is not null")
        .join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]))
    return found, log(share[1] / share[0])
