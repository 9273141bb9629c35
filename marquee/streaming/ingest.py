"""Landed payload files as a stream into a bucketed table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.mutate import latest_by_key
from marquee.session import materialize
from marquee.sources.frames import path_exists
from marquee.sources.payloads import PAYLOADS, _corrupt, valid_payload
from marquee.sources.deltas import DeltaTable
from marquee.sources.tables import read_bucketed, upsert_bucketed, write_bucketed


def newer_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """Batch rows whose stamp is later than the stored one, or whose key is new."""
    stored = target.select(*keys, F.col(stamp).alias("__stored")).join(batch.select(*keys), list(keys), "left_semi")
    joined = batch.join(stored, list(keys), "left")
    return joined.where(F.col("__stored").isNull() | (F.col(stamp) > F.col("__stored"))).drop("__stored")


def merge_batch(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], stamp: str, buckets: int) -> None:
    """Upsert one batch; a replayed or late batch changes nothing, because only newer stamps win."""
    rows = materialize(latest_by_key(batch, keys, [stamp]), "micro-batch")
    if not path_exists(spark, path):
        write_bucketed(rows, path, keys, buckets)
        return
    stored = read_bucketed(spark, path, rows, keys, buckets)
    fresh = materialize(newer_rows(stored, rows, keys, stamp), "newer")
    upsert_bucketed(spark, path, fresh, keys, buckets)


def ingest_stream(spark: SparkSession, landing: str, kind: str, normalize: Callable[[DataFrame], DataFrame], path: str,
                  keys: Sequence[str], checkpoint: str, stamp: str = "fetched_at", buckets: int = 16,
                  files_per_batch: int = 1000, rejects: str | None = None) -> StreamingQuery:
    """Read payload files as they land and upsert them by key.

    Payload lines carry ``fetched_at`` (UTC, without a zone) next to their own fields; it orders the versions of a
    row. There is no state and no watermark: the merge lets only newer stamps win, so repeats and replays change
    nothing, and a row that arrives late is taken however old it is. Lines that are invalid, or lack the stamp or the
    key, do not reach the table; with ``rejects`` they are kept there, one folder per batch. Runs until all
    files present are taken.
    """
    schema = _corrupt(PAYLOADS[kind]).add("fetched_at", "timestamp_ntz")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(landing)
    id_column = {"details": "id", "title": "imdbID", "discover": "id"}[kind]
    good = valid_payload(source, kind) & F.col("fetched_at").isNotNull() & F.col(id_column).isNotNull()

    def take(batch: DataFrame, batch_id: int) -> None:
        valid = batch.where("__good").drop("__good")
        merge_batch(batch.sparkSession, normalize(valid), path, keys, stamp, buckets)
        if rejects:
            batch.where("NOT __good").drop("__good").write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")

    return (
        source.withColumn("__good", F.coalesce(good, F.lit(False))).writeStream.outputMode("append").foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def commit_batch(table: DeltaTable, batch: DataFrame, batch_id: int, stream: str, stamp: str, files: list[str],
                 before_commit: Callable[[], None] | None = None) -> bool:
    """Merge one micro-batch into ``table`` unless the table's ledger already holds it; True if it was merged now.

    The batch id and the batch's source files are written in the same manifest as its rows, so the lookup
    decides: a batch that died before its commit left nothing and runs again; one that committed is skipped.
    """
    done = table.ledger().get(stream, {}).get("batch", -1)
    if batch_id <= done:
        return False
    table.merge_newest(batch, stamp, {stream: {"batch": batch_id, "files": sorted(files)}}, before_commit)
    return True


def ingest_stream_ledger(spark: SparkSession, landing: str, kind: str, normalize: Callable[[DataFrame], DataFrame], path: str,
                         keys: Sequence[str], checkpoint: str, stamp: str = "fetched_at", files_per_batch: int = 1000,
                         stream: str | None = None, before_commit: Callable[[], None] | None = None) -> StreamingQuery:
    """Read payload files as they land and merge them into a versioned table, exactly once per batch.

    Per key the row with the latest stamp wins; equal stamps go to the larger row by its other columns, so any
    order of arrival ends in the same table. Lines that are invalid, or lack the stamp or the key, do not reach
    the table. ``before_commit`` runs between writing a batch's files and committing them (for tests).
    """
    schema = _corrupt(PAYLOADS[kind]).add("fetched_at", "timestamp_ntz")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(landing)
    id_column = {"details": "id", "title": "imdbID", "discover": "id"}[kind]
    good = valid_payload(source, kind) & F.col("fetched_at").isNotNull() & F.col(id_column).isNotNull()
    name = stream or checkpoint
    table = DeltaTable(spark, path)

    def take(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(normalize(batch.where(F.coalesce(good, F.lit(False)))), "micro-batch")
        files = [r[0] for r in batch.select(F.input_file_name()).distinct().collect()]  # at most files_per_batch
        if table.version() < 0:
            table.create(rows.limit(0), keys)
        commit_batch(table, rows, batch_id, name, stamp, files, before_commit)

    return (
        source.writeStream.outputMode("append").foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
