"""Versioned keyed tables: merge on read, readers on old versions, killed writers, conflicts, compaction, ledgers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import mutate
from marquee.session import scratch_path
from marquee.sources.deltas import CommitConflict, DeltaTable

SCHEMA = "k long, name string, amount double"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark):
    base = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
                                    (F.col("id") * 1.5).alias("amount"))
    t = DeltaTable(spark, scratch_path(spark, "delta"))
    t.create(base, ["k"])
    return t, base


def folder_bytes(t, kind, name):
    return t._fs.getContentSummary(t._Path(f"{t.path}/{kind}/{name}")).getLength()


def test_upsert_equals_frame_upsert_and_writes_little(spark, table):
    t, base = table
    batch = spark.createDataFrame([(k, f"changed{k}", None) for k in range(0, 1600, 100)] + [(5000, "new", 1.0), (None, "keyless", 2.0)], SCHEMA)
    t.upsert(batch.select("k", "name"), "replace", {"amount": -1.0})
    want = mutate.upsert(base, batch.select("k", "name"), ["k"], "replace", {"amount": -1.0})
    assert rows_of(t.read()) == rows_of(want)
    m = t.manifest()
    assert m["version"] == 1 and len(m["data"]) == 2 and len(m["deletes"]) == 1
    # 16 changed keys and one new: the commit writes kilobytes, the table is not rewritten.
    assert folder_bytes(t, "data", m["data"][-1]) < 40_000 and folder_bytes(t, "deletes", m["deletes"][-1]) < 40_000
    patched = spark.createDataFrame([(3, None, 9.0)], SCHEMA).select("k", "amount")
    t.upsert(patched, "patch")
    assert [tuple(r) for r in t.read().where("k = 3").collect()] == [(3, "n3", 9.0)]


def test_reader_keeps_its_version(spark, table):
    t, base = table
    before = t.read()
    t.upsert(spark.createDataFrame([(1, "x", 0.0)], SCHEMA))
    assert rows_of(before) == rows_of(base)            # planned before the commit: the old files only
    assert rows_of(t.read(0)) == rows_of(base)
    assert t.read().where("k = 1").first().name == "x"


def test_killed_writer_changes_nothing(spark, table):
    t, base = table

    def die():
        raise KeyboardInterrupt("writer killed before its commit")

    with pytest.raises(KeyboardInterrupt):
        t.upsert(spark.createDataFrame([(1, "x", 0.0)], SCHEMA), before_commit=die)
    assert t.version() == 0 and rows_of(t.read()) == rows_of(base)
    assert t.vacuum(keep_from=0) == 2                    # its data and delete files, named by no manifest
    assert rows_of(t.read()) == rows_of(base)


def test_racing_writers(spark, table):
    t, _ = table
    base = t.manifest()
    t.change(spark.createDataFrame([(7, "a", 1.0)], SCHEMA), t._rows(base, True).where("k = 7"), base=base)
    with pytest.raises(CommitConflict):
        t.change(spark.createDataFrame([(7, "b", 1.0)], SCHEMA), t._rows(base, True).where("k = 7"), base=base)
    assert t.read().where("k = 7").first().name == "a"


def test_compaction_keeps_rows(spark, table):
    t, _ = table
    rng = random.Random(2)
    for i in range(5):
        t.upsert(spark.createDataFrame([(rng.randrange(3000), f"v{i}", float(i)) for _ in range(20)], SCHEMA))
    want = rows_of(t.read())
    assert t.needs_compaction(max_deltas=4)
    t.compact(target_bytes=16_000)
    m = t.manifest()
    assert m["deletes"] == [] and len(m["data"]) == 1 and rows_of(t.read()) == want
    assert rows_of(t.read(m["version"] - 1)) == want


def test_newest_wins_in_any_order(spark):
    at = dt.datetime(2001, 1, 1)
    a = [(1, "a", at), (2, "b", at), (3, "zz", at)]
    b = [(1, "a2", at + dt.timedelta(hours=1)), (2, "b", at - dt.timedelta(hours=1)), (3, "yy", at), (4, "new", at)]
    schema = "k long, name string, ts timestamp"
    results = []
    for first, second in ((a, b), (b, a)):
        t = DeltaTable(spark, scratch_path(spark, "delta"))
        t.create(spark.createDataFrame([], schema), ["k"])
        t.merge_newest(spark.createDataFrame(first, schema), "ts")
        t.merge_newest(spark.createDataFrame(second, schema), "ts")
        assert t.merge_newest(spark.createDataFrame(second, schema), "ts") is None      # a replay changes nothing
        results.append(rows_of(t.read()))
    assert results[0] == results[1]
    assert [r[1] for r in results[0]] == ["a2", "b", "zz", "new"]
