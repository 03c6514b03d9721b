"""Session settings for lake jobs."""

from __future__ import annotations

import math
import threading
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

JOB_CONF = {
    # re-plan joins, merge small partitions, split skewed ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target of rebalanced writes, and so of layer files
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
}

PARTITIONS = "spark.sql.shuffle.partitions"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SPLIT = "spark.sql.files.maxPartitionBytes"

# Most that a task of a write takes in, before adaptive execution merges or splits anything: stored
# bytes for each shuffle partition, bytes of shuffled rows, and bytes of a scanned split. Sorted rows take
# up to 18 times the room of their shuffled bytes, so four such tasks stay far under an executor's memory.
STORED_SHARE, SHUFFLED_SHARE, SCANNED_SHARE = 4 << 20, 24 << 20, 32 << 20

_lock = threading.Lock()
# application -> (writes under way, settings before the first of them)
_under_way: dict[str, tuple[int, dict[str, str]]] = {}


def shuffle_partitions(input_bytes: int, cores: int, target: int = 128 << 20) -> int:
    """Shuffle partitions for a job over so many stored bytes, some per core at least.

    Adaptive execution merges partitions that turn out small but does not split evenly
    large ones, so this errs on the high side: one for each ``target`` of the input, which
    holds as shuffles carry fewer columns than the files and are compressed too.
    """
    return max(2 * cores, math.ceil(input_bytes / target))


def stored_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes of all files below the paths, as the store tells; absent paths have none."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    total = 0
    for path in map(hadoop.Path, paths):
        store = path.getFileSystem(conf)
        if store.exists(path):
            total += store.getContentSummary(path).getLength()
    return total


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def read_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, from one listing of each folder."""
    spark, wanted = df.sparkSession, {}
    for file in df.inputFiles():
        folder, name = file.rsplit("/", 1)
        wanted.setdefault(folder, set()).add(name)
    total = 0
    for folder, names in wanted.items():
        # names of input files are escaped as in URIs
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f"{folder}/"))
        for file in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
            if file.getPath().toUri().getRawPath().rsplit("/", 1)[-1] in names:
                total += file.getLen()
    return total


@contextmanager
def sized_for(df: DataFrame) -> Iterator[None]:
    """Bounds what each task holds while ``df`` is written, whatever its size.

    The number of shuffle partitions grows with the stored bytes that ``df`` reads, and tasks are merged
    up to a fixed size only. Settings that ask for more or smaller tasks stay. They are put back when no
    write is under way any more.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    parts = math.ceil(read_bytes(df) / STORED_SHARE)
    with _lock:
        now = {key: spark.conf.get(key) for key in (PARTITIONS, ADVISORY, SPLIT)}
        writes, before = _under_way.get(app, (0, now))
        _under_way[app] = writes + 1, before
        spark.conf.set(PARTITIONS, str(max(int(now[PARTITIONS]), parts)))
        for key, share in ((ADVISORY, SHUFFLED_SHARE), (SPLIT, SCANNED_SHARE)):
            spark.conf.set(key, f"{min(_bytes(spark, now[key]), share)}b")
    try:
        yield
    finally:
        with _lock:
            writes, before = _under_way.pop(app)
            if writes > 1:
                _under_way[app] = writes - 1, before
            else:
                for key, value in before.items():
                    spark.conf.set(key, value)


def launched(spark: SparkSession) -> dict[str, str]:
    """Settings that the application was launched with."""
    return dict(spark.sparkContext.getConf().getAll())


def job_session(app: str, inputs: Iterable[str] = ()) -> SparkSession:
    """A session with the job settings, except those the launcher already set.

    The number of shuffle partitions follows from the bytes of the job's ``inputs``.
    """
    spark = SparkSession.builder.appName(app).getOrCreate()
    launched_with = launched(spark)
    settings = dict(JOB_CONF)
    if inputs:
        settings[PARTITIONS] = str(shuffle_partitions(
            stored_bytes(spark, inputs), spark.sparkContext.defaultParallelism))
    for key, value in settings.items():
        if key not in launched_with:
            spark.conf.set(key, value)
    return spark
