"""Publishing marts as catalog tables, with checks and audits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.schemas import Field, Table
from playbill.session import sized_for

REASON = "reject_reason"


def _issues(field: Field, has_type: str) -> list[Column]:
    """Expressions giving a text for each rule the column breaks, else NULL."""
    col = F.col(field.name)
    typed, found = col, []
    if has_type != field.type:
        typed = col.try_cast(field.type)
        found.append(F.when(
            col.isNotNull() & typed.isNull(), f"{field.name}: not {field.type}"))
    if field.required:
        found.append(F.when(col.isNull(), f"{field.name}: null"))
    if field.limit:
        if field.type.startswith("array"):
            long = F.exists(typed, lambda e: F.octet_length(e) > field.limit)
        else:
            long = F.octet_length(typed) > field.limit
        found.append(F.when(long, f"{field.name}: longer than {field.limit}"))
    return found


def conform(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows that fit ``table`` and rows that do not.

    Good rows have the declared columns, order and types. Rejected rows keep
    their values as they came, with the broken rules in ``reject_reason``.
    """
    absent = [c for c in table.columns if c not in df.columns]
    if absent:
        raise ValueError(f"{table.name}: missing columns {', '.join(absent)}")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.select(*table.columns)
    issues = [i for f in table.fields for i in _issues(f, types[f.name])]
    checked = rows.withColumn(
        REASON, F.concat_ws("; ", *issues) if issues else F.lit(""))
    good = checked.where(F.col(REASON) == "").select(*[
        (F.col(f.name) if types[f.name] == f.type
         else F.col(f.name).try_cast(f.type)).alias(f.name)
        for f in table.fields
    ])
    return good, checked.where(F.col(REASON) != "")


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is absent."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def _rows(spark: SparkSession, table: str) -> int:
    """Rows of a table, 0 if there is none; Parquet answers from its footers."""
    return spark.table(table).count() if spark.catalog.tableExists(table) else 0


def stored_buckets(spark: SparkSession, table: str) -> int:
    """Buckets a table was declared with, 0 if it is not bucketed."""
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Num Buckets'").first()
    return int(described["data_type"]) if described else 0


def publish(
    df: DataFrame,
    table: Table,
    database: str,
    mode: str = "overwrite",
    buckets: int | None = None,
    layout: str = "bucketed",
) -> DataFrame:
    """Publish a mart as a catalog table and return its audit row.

    Rows that break the declared rules go to ``<table>_rejected``. ``buckets`` is the declared
    number unless given; a reader's task takes one bucket, so give more for a larger mart. Each
    bucket may be written by several tasks, so a hot key does not end in one. With
    ``layout="sorted"`` rows lie the same way but the table is not declared bucketed,
    and readers may split it freely.

    ``overwrite`` replaces the table and can be repeated safely; ``append`` adds the rows again
    on every call, in the layout that the table has. ``df`` should be a stored layer: good
    and rejected rows are written in separate passes, and each count is taken on its own.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode}")
    if layout not in ("bucketed", "sorted"):
        raise ValueError(f"layout must be bucketed or sorted, not {layout}")
    spark, key = df.sparkSession, table.bucket_by
    target, quarantine = (f"`{database}`.`{table.name}{s}`" for s in ("", "_rejected"))
    good, rejected = conform(df, table)

    appending = mode == "append" and spark.catalog.tableExists(target)
    before = [_rows(spark, t) if appending else 0 for t in (target, quarantine)]
    declared = stored_buckets(spark, target) if appending else 0
    count = declared or buckets or table.buckets
    order = table.publish_order or (key,)
    laid_out = (
        good.withColumn("_bucket", F.pmod(F.hash(key), F.lit(count)))
        .hint("rebalance", "_bucket")
        .drop("_bucket")
    )
    with sized_for(df):
        if appending:
            laid_out.sortWithinPartitions(*order).write.insertInto(target)
        elif layout == "bucketed":
            laid_out.write.bucketBy(count, key).sortBy(*order).mode("overwrite").format(
                "parquet").saveAsTable(target)
        else:
            laid_out.sortWithinPartitions(*order).write.mode("overwrite").format(
                "parquet").saveAsTable(target)
        rejected.write.mode("append" if appending else "overwrite").format("parquet").saveAsTable(
            quarantine)
    source_rows = df.count()
    published_rows = _rows(spark, target) - before[0]
    rejected_rows = _rows(spark, quarantine) - before[1]
    return spark.createDataFrame(
        [(table.name, source_rows, published_rows, rejected_rows,
          source_rows == published_rows + rejected_rows)],
        "table_name string, source_rows bigint, published_rows bigint, "
        "rejected_rows bigint, balanced boolean")


def audit_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of (table_name, row_count); stored tables are counted from footers."""
    return reduce(DataFrame.unionAll, [
        df.agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def completeness(
    spark: SparkSession, manifest: Iterable[str], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Rows of (table_name, row_count, has_rows), one per required table.

    Every given table is read to its end and counted; one that is not given has no rows.
    """
    required = spark.createDataFrame([(name,) for name in manifest], "table_name string")
    if tables:
        required = required.join(audit_counts(tables), "table_name", "left")
    else:
        required = required.withColumn("row_count", F.lit(None).cast("bigint"))
    rows = F.coalesce("row_count", F.lit(0)).cast("bigint")
    return required.select("table_name", rows.alias("row_count"), (rows > 0).alias("has_rows"))
