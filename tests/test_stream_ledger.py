"""Exactly-once stream commits by the table's ledger: a writer killed before its commit, then the replay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marquee.plans import ingestion
from marquee.session import scratch_path
from marquee.sources.deltas import DeltaTable
from marquee.streaming.ingest import commit_batch, ingest_stream_ledger

COLUMNS = ["tmdb_id", "title", "fetched_at", "genres", "revenue"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def run_stream(spark, sf_dir, before_commit=None, parts=None):
    columns, all_parts = ingestion._stream_parts(spark, sf_dir)
    landing, path, checkpoint = (scratch_path(spark, x) for x in ("landing", "table", "checkpoint"))
    for part in parts or all_parts:
        ingestion._land(part.where("id IS NULL OR id % 4 = 0"), columns, landing)
    return landing, path, checkpoint, columns


def test_killed_before_commit_then_replayed(spark, sf_dir):
    landing, path, checkpoint, _ = run_stream(spark, sf_dir)

    def die():
        raise RuntimeError("executor lost between write and commit")

    with pytest.raises(Exception):
        ingest_stream_ledger(spark, landing, "details", ingestion._normalize, path, ["tmdb_id"], checkpoint, before_commit=die).awaitTermination()
    table = DeltaTable(spark, path)
    assert table.version() <= 0 and (table.version() < 0 or table.read().count() == 0)
    ingest_stream_ledger(spark, landing, "details", ingestion._normalize, path, ["tmdb_id"], checkpoint).awaitTermination()
    committed = table.version()
    assert table.ledger()[checkpoint]["batch"] == 0 and table.ledger()[checkpoint]["files"]

    # The same files once more under a fresh checkpoint give the same rows as a run that was never killed.
    clean_path, clean_checkpoint = scratch_path(spark, "table"), scratch_path(spark, "checkpoint")
    ingest_stream_ledger(spark, landing, "details", ingestion._normalize, clean_path, ["tmdb_id"], clean_checkpoint).awaitTermination()
    assert rows_of(table.read()) == rows_of(DeltaTable(spark, clean_path).read())
    assert table.version() == committed


def test_committed_batch_is_skipped_by_lookup(spark):
    schema = "k long, v string, ts timestamp"
    at = dt.datetime(2001, 1, 1)
    table = DeltaTable(spark, scratch_path(spark, "table"))
    table.create(spark.createDataFrame([], schema), ["k"])
    batch = spark.createDataFrame([(1, "a", at), (2, "b", at)], schema)
    assert commit_batch(table, batch, 0, "s", "ts", ["f1"])
    version = table.version()
    # Spark replays batch 0 after a loss between the table's commit and its own checkpoint: nothing happens.
    assert not commit_batch(table, batch.withColumn("v", F.lit("changed")), 0, "s", "ts", ["f1"])
    assert table.version() == version and sorted(r.v for r in table.read().collect()) == ["a", "b"]
    assert commit_batch(table, spark.createDataFrame([(1, "z", at)], schema), 1, "s", "ts", ["f2"])
    assert table.ledger()["s"] == {"batch": 1, "files": ["f2"]}
    # Equal stamps, other payload: the larger row wins, whichever came first.
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, "z"), (2, "b")]
