"""Catalog tables: contracts, parquet import/export, parameter queries and keyed writes.

A table points at one version folder below the warehouse root. A change writes the next version in
full and then moves the table's location, so readers never see half a change and a failed write
leaves the table as it was. Tables created with ``buckets`` are split by key hash, and an upsert
rewrites only the buckets the batch touches.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marquee.operators.mutate import upsert
from marquee.schemas import TABLES, TABLE_KEYS, table_defaults
from marquee.session import materialize
from marquee.sources.frames import path_exists

BUCKET = "key_bucket"


def _version_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/v-{uuid.uuid4().hex}"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def create_tables(spark: SparkSession, root: str, tables: dict[str, T.StructType] | None = None) -> list[str]:
    """Create the missing contract tables and return the names of all of them."""
    names = []
    for name, schema in (tables or TABLES).items():
        names.append(name)
        if not table_exists(spark, name):
            _point_at(spark, name, spark.createDataFrame([], schema), root)
    return names


def _point_at(spark: SparkSession, table: str, df: DataFrame, root: str) -> None:
    path = _version_path(root, table)
    df.write.parquet(path)
    if table_exists(spark, table):
        if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        # Other columns need another table: it is complete under a name of its own before the old one goes.
        following = f"{table}_next_{uuid.uuid4().hex}"
        spark.catalog.createTable(following, path=path, source="parquet", schema=df.schema)
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
        return
    spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)


def write_table(df: DataFrame, table: str, root: str) -> None:
    """Write ``df`` as the next version of ``table``; ``df`` may read the current one."""
    _point_at(df.sparkSession, table, df, root)


def import_parquet(spark: SparkSession, table: str, path: str, root: str) -> None:
    """Create or replace ``table`` with the content of a parquet path."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    _point_at(spark, table, spark.read.parquet(path), root)


def append_parquet(spark: SparkSession, table: str, path: str, root: str) -> None:
    """Append a parquet path by column position; creates the table if absent."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    if not table_exists(spark, table):
        import_parquet(spark, table, path, root)
        return
    spark.read.parquet(path).write.insertInto(table)


def export_table(spark: SparkSession, table: str, path: str) -> str:
    spark.table(table).write.mode("overwrite").parquet(path)
    return path


def new_key_rows(store: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key, compared as text, the store lacks. Keyless rows are new."""
    known = store.select(F.col(key).cast("string").alias("__known")).where("__known is not null")
    return incoming.join(known, F.col(key).cast("string") == F.col("__known"), "left_anti")


def append_new_keys(spark: SparkSession, table: str, incoming: DataFrame, key: str, root: str) -> None:
    """Append only the rows with unseen keys."""
    if not table_exists(spark, table):
        write_table(incoming, table, root)
        return
    # Settled first: the anti join reads the table that the insert adds files to.
    fresh = materialize(new_key_rows(spark.table(table), incoming, key), "new-keys")
    fresh.select(*spark.table(table).columns).write.insertInto(table)


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if not t.isTemporary)


def column_info(df: DataFrame) -> DataFrame:
    """Per column: position, type and number of non-missing rows."""
    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema]
    counted = df.agg(*[F.count(F.col(n)).alias(f"c{i}") for i, (n, _) in enumerate(kinds)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.lit(k).alias("column_type"),
                 F.col(f"c{i}").alias("non_null")) for i, (n, k) in enumerate(kinds)])
    return counted.select(F.inline(rows))


def key_faults(df: DataFrame, table: str) -> DataFrame:
    """(table_name, null_keys, repeated_keys): rows without the table's key, and keys that stand in several rows."""
    keys = TABLE_KEYS[table]
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return per_key.agg(
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~missing & (F.col("n") > 1)).alias("repeated_keys")).select(F.lit(table).alias("table_name"), "null_keys", "repeated_keys")


def run_sql(spark: SparkSession, text: str, params: Sequence[Any] | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with positional ``?`` parameters; ``{name}`` in the text stands for the frame of that name.

    No view is left in the session.
    """
    return spark.sql(text, args=list(params) if params else None, **frames)


def upsert_table(spark: SparkSession, table: str, incoming: DataFrame, keys: Sequence[str], root: str,
                 mode: str = "replace", order: Sequence[str] = (), *, as_of: dt.datetime) -> None:
    """Upsert a batch into a catalog table by writing its next version; new rows get the table's defaults."""
    merged = upsert(spark.table(table), incoming, keys, mode, table_defaults(table, as_of), order)
    write_table(merged, table, root)


def save_clustered(df: DataFrame, table: str, path: str, key: str, buckets: int, sort_by: str | None = None) -> None:
    """Save as a table hashed on ``key``, so joins of equally bucketed tables on it need no shuffle.

    ``sort_by`` orders the rows of a bucket, which lets filters on that column skip row groups.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(sort_by or key).saveAsTable(table)


def _with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write ``df`` split into one folder per key bucket."""
    # A second, finer hash lets several tasks fill one folder.
    placed = _with_bucket(df, keys, buckets)
    placed.repartition(BUCKET, F.pmod(F.hash(*keys), F.lit(8))).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_bucketed(spark: SparkSession, path: str, touched_by: DataFrame | None = None, keys: Sequence[str] = (),
                  buckets: int = 0) -> DataFrame:
    """The rows of a bucketed folder, or only the buckets that rows of ``touched_by`` fall into."""
    rows = spark.read.parquet(path)
    if touched_by is not None:
        rows = rows.where(F.col(BUCKET).isin(_touched(_with_bucket(touched_by.select(*keys), keys, buckets))))
    return rows.drop(BUCKET)


def _touched(batch: DataFrame) -> list[int]:
    """At most as many numbers as there are buckets."""
    return [r[0] for r in batch.select(BUCKET).distinct().collect()]


def upsert_bucketed(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], buckets: int,
                    mode: str = "replace", order: Sequence[str] = ()) -> None:
    """Upsert into a bucketed folder, reading and rewriting only the touched buckets.

    The merged buckets are written to the shared folder first. Replacing them afterwards is a plain
    copy that can be repeated if it is interrupted.
    """
    target = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in target.schema}
    batch = _with_bucket(
        incoming.select(*[F.col(c).cast(kinds[c]).alias(c) for c in incoming.columns]), keys, buckets)
    touched = _touched(batch)
    if not touched:
        return
    merged = upsert(target.where(F.col(BUCKET).isin(touched)), batch, [*keys, BUCKET], mode, None, order)
    staged = materialize(merged, "upsert")
    (
        staged.repartition(BUCKET, F.pmod(F.hash(*keys), F.lit(8)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    )
