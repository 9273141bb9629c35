"""Upserts, versioned and bucketed tables, frame files, payload validation, streaming replays."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from marquee.functions.dates import age_category, refresh_interval
from marquee.operators import mutate, refresh
from marquee.operators.joins import lookup
from marquee.plans import derived
from marquee.schemas import TABLE_DEFAULTS, TABLES
from marquee.session import scratch_path
from marquee.sources import frames, payloads, tables
from marquee.streaming.ingest import merge_batch

AS_OF = dt.datetime(2024, 6, 1, 12)


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name, scratch_path(spark, "tables")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def movie(spark, rows):
    return spark.createDataFrame(rows, "tmdb_id int, title string")


def test_contract_tables_and_upsert(spark, database):
    name, root = database
    contracts = {f"{name}.{t}": s for t, s in TABLES.items()}
    assert tables.create_tables(spark, root, contracts) == tables.create_tables(spark, root, contracts)
    assert all(tables.table_exists(spark, t) for t in contracts) and not tables.table_exists(spark, f"{name}.none")
    target = f"{name}.movies"
    tables.upsert_table(spark, target, movie(spark, [(12345, "Test Movie")]), ["tmdb_id"], root, as_of=AS_OF)
    tables.upsert_table(spark, target, movie(spark, [(12345, "Test Movie UPDATED")]), ["tmdb_id"], root, as_of=AS_OF)
    assert rows_of(spark.table(target), "tmdb_id", "title") == [(12345, "Test Movie UPDATED")]
    assert [r.col_name for r in tables.describe_table(spark, target).collect()] == TABLES["movies"].names


def test_three_rows_then_one_update_and_parameters(spark, database):
    name, root = database
    target = f"{name}.m"
    tables.write_table(movie(spark, [(1, "Movie A"), (2, "Movie B"), (3, "Movie C")]), target, root)
    tables.upsert_table(spark, target, movie(spark, [(1, "Movie A Updated")]), ["tmdb_id"], root, as_of=AS_OF)
    assert rows_of(spark.table(target), "tmdb_id", "title") == [(1, "Movie A Updated"), (2, "Movie B"), (3, "Movie C")]
    found = tables.run_sql(spark, f"SELECT title FROM {target} WHERE tmdb_id = ?", [2]).collect()
    assert [r.title for r in found] == ["Movie B"]


TARGET = "tmdb_id int, title string, last_tmdb_update string, data_frozen boolean"


def test_replace_and_patch_differ_in_untouched_columns(spark):
    target = spark.createDataFrame([(1, "a", "old", True), (2, "b", "old", True), (None, "n", "old", True)], TARGET)
    batch = movie(spark, [(1, "a2"), (3, "c"), (None, "m")])
    replaced = mutate.upsert(target, batch, ["tmdb_id"], "replace", TABLE_DEFAULTS["movies"])
    assert rows_of(replaced, *target.columns) == sorted([
        (1, "a2", None, False), (2, "b", "old", True), (3, "c", None, False), (None, "m", None, False),
        (None, "n", "old", True)], key=repr)
    patched = mutate.upsert(target, batch, ["tmdb_id"], "patch", TABLE_DEFAULTS["movies"])
    assert rows_of(patched, *target.columns) == sorted([
        (1, "a2", "old", True), (2, "b", "old", True), (3, "c", None, False), (None, "m", None, False),
        (None, "n", "old", True)], key=repr)
    for mode in ("replace", "patch"):
        once = mutate.upsert(target.where("tmdb_id is not null"), batch.where("tmdb_id is not null"), ["tmdb_id"], mode)
        twice = mutate.upsert(once, batch.where("tmdb_id is not null"), ["tmdb_id"], mode)
        assert rows_of(once, *target.columns) == rows_of(twice, *target.columns)
    assert rows_of(mutate.upsert(target, batch.limit(0), ["tmdb_id"]), *target.columns) == rows_of(target, *target.columns)


def test_patch_can_write_null_and_latest_duplicate_wins(spark):
    target = spark.createDataFrame([(1, "a", "old", True)], TARGET)
    batch = spark.createDataFrame([(1, None)], "tmdb_id int, title string")
    assert rows_of(mutate.upsert(target, batch, ["tmdb_id"], "patch"), "title", "data_frozen") == [(None, True)]
    copies = spark.createDataFrame([(1, "x", "2"), (1, "y", "9"), (1, "z", "10")], "tmdb_id int, title string, last_tmdb_update string")
    got = mutate.upsert(target, copies, ["tmdb_id"], order=["last_tmdb_update"])
    assert rows_of(got, "title") == [("y",)]
    with pytest.raises(ValueError):
        mutate.upsert(target, target.withColumn("other", F.lit(1)), ["tmdb_id"])


@pytest.mark.parametrize("mode", ["replace", "patch"])
def test_bucketed_upsert_equals_plain_upsert(spark, mode):
    target = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("t").alias("s"))
    batch = spark.range(190, 215).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))
    path = scratch_path(spark, "bucketed")
    tables.write_bucketed(target, path, ["k"], 7)
    tables.upsert_bucketed(spark, path, batch, ["k"], 7, mode)
    assert rows_of(tables.read_bucketed(spark, path), "k", "v", "s") == rows_of(mutate.upsert(target, batch, ["k"], mode), "k", "v", "s")


def test_dense_ids_continue_after_the_largest(spark):
    rows = spark.createDataFrame([(None, 5), (7, 1), (None, 3), (None, 9)], "movie_id int, tmdb_id int")
    assert rows_of(mutate.assign_ids(rows, "movie_id", ["tmdb_id"]), "tmdb_id", "movie_id") == [(1, 7), (3, 8), (5, 9), (9, 10)]
    none = rows.where("movie_id is null")
    assert rows_of(mutate.assign_ids(none, "movie_id", ["tmdb_id"]), "tmdb_id", "movie_id") == [(3, 1), (5, 2), (9, 3)]


def test_append_new_keys(spark, database):
    name, root = database
    store = spark.createDataFrame([("1", "a"), (None, "n")], "k string, v string")
    tables.append_new_keys(spark, f"{name}.s", store, "k", root)
    tables.append_new_keys(spark, f"{name}.s", spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string"), "k", root)
    assert rows_of(spark.table(f"{name}.s"), "k", "v") == sorted([("1", "a"), (None, "n"), ("2", "y"), (None, "z")], key=repr)


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_frame_round_trip(spark, format):
    df = spark.createDataFrame([(1, 4, 7), (2, 5, 8), (3, 6, 9)], "a int, b int, c int")
    path = frames.write_frame(df, "frame", scratch_path(spark, "frames"), format)
    assert path.endswith(f"frame.{format}")
    back = frames.read_frame(spark, path)
    assert back.columns == ["a", "b", "c"] and rows_of(back, "a", "b", "c") == [(1, 4, 7), (2, 5, 8), (3, 6, 9)]
    with pytest.raises(FileNotFoundError):
        frames.read_frame(spark, path + ".none")
    with pytest.raises(ValueError):
        frames.read_frame(spark, path, "feather")


def test_csv_keeps_quotes_and_line_breaks(spark):
    df = spark.createDataFrame([(1, 'say "hi", now\nagain'), (2, None)], "a int, t string")
    path = frames.write_frame(df, "text", scratch_path(spark, "frames"), "csv")
    assert rows_of(frames.read_frame(spark, path, schema=df.schema, multi_line=True), "a", "t") == rows_of(df, "a", "t")


def test_invalid_payloads_are_rejected(spark):
    path = scratch_path(spark, "landing")
    good = ('{"id":1,"title":"t","status":"s","budget":1,"revenue":2,"vote_count":3,"vote_average":1.5,"popularity":2.0,'
            '"genres":[{"id":1,"name":"g"},{"id":2,"name":"h"}],"production_companies":[],"production_countries":[],"spoken_languages":[]}')
    lines = [good, good.replace('"title":"t",', ""), good.replace('"name":"g"', '"name":null'), "{broken", '{"id":"x"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    valid, rejected = payloads.quarantine(payloads.read_payloads(spark, path, "details"), "details")
    assert (valid.count(), rejected.count()) == (1, 4)
    assert payloads.normalize_details(valid, AS_OF).first()["genres"] == "g,h"


def test_discover_filter(spark):
    schema = "id long, title string, release_date string, vote_count long, adult boolean, video boolean"
    items = spark.createDataFrame([
        (1, "a", "2020-05-01", 300, False, False), (1, "a", "2020-05-01", 310, False, False), (2, "b", "2020-06-01", 199, False, False),
        (3, "c", "2020-07-01", 500, True, False), (4, "d", "2021-01-01", 500, False, False), (5, "e", "", 500, False, False),
        (6, "f", "2020-12-31", 200, None, None)], schema)
    assert rows_of(payloads.discover_filter(items, 2020), "id", "vote_count") == [(1, 310), (6, 200)]
    many = spark.range(100).select("id", F.lit("t").alias("title"), F.lit("2020-01-01").alias("release_date"),
                                   F.lit(500).cast("long").alias("vote_count"), F.lit(False).alias("adult"), F.lit(False).alias("video"))
    assert payloads.discover_filter(many, 2020, max_pages=2).count() == 40


def test_replayed_and_late_batches_change_nothing(spark):
    path = scratch_path(spark, "stream-table")
    schema = "k int, v string, at timestamp_ntz"
    day = [dt.datetime(2024, 1, d) for d in range(1, 5)]
    batches = [[(1, "a", day[1]), (2, "b", day[1])], [(1, "a3", day[3]), (2, "late", day[0]), (3, "c", day[2])]]
    for rows in (batches[0], batches[1], batches[1], batches[0]):
        merge_batch(spark, spark.createDataFrame(rows, schema), path, ["k"], "at", 4)
    assert rows_of(tables.read_bucketed(spark, path), "k", "v") == [(1, "a3"), (2, "b"), (3, "c")]


def test_age_and_freeze_rules(spark):
    ages = [-3, 0, 60, 61, 180, 181, 365, 366, 500, 730]
    rows = spark.createDataFrame([(a, (AS_OF - dt.timedelta(days=a)).date()) for a in ages] + [(None, None)], "a int, d date")
    got = {r[0]: (r[1], r[2], r[3]) for r in rows.select(
        "a", age_category("d", AS_OF), refresh_interval("d", "tmdb", AS_OF), refresh_interval("d", "omdb", AS_OF)).collect()}
    assert [got[a][0] for a in ages] == ["recent"] * 3 + ["established"] * 2 + ["mature"] * 2 + ["archived"] * 3
    assert got[500][1:] == (90, 180) and got[None] == (None, None, None)
    frozen = spark.createDataFrame([(730, True, 3), (730, True, 2), (730, False, 3), (100, True, 3)], "a int, s boolean, c int")
    frozen = frozen.withColumn("d", F.date_sub(F.lit(AS_OF.date()), F.col("a"))).withColumn("t", F.when(F.col("s"), F.lit(AS_OF)))
    rule = mutate.should_freeze(F.col("d"), F.col("t"), F.lit(None).cast("timestamp"), F.col("c"), AS_OF)
    assert [r[0] for r in frozen.select(rule).collect()] == [True, False, False, False]


def test_elapsed_and_calendar_rules_differ(spark):
    """23:00 five days ago is due by calendar days, but not yet by elapsed time."""
    last = dt.datetime(2024, 5, 27, 23)
    rows = spark.createDataFrame([(1, AS_OF.date(), last, False)], "movie_id int, release_date date, last_tmdb_update timestamp_ntz, data_frozen boolean")
    rows = rows.withColumns({c: F.col("last_tmdb_update") for c in ("last_omdb_update", "last_numbers_update", "last_full_refresh")})
    rows = rows.withColumns({"tmdb_id": F.col("movie_id"), "imdb_id": F.lit("x"), "title": F.lit("t")})
    assert refresh.due_queue(rows, AS_OF).count() == 1
    assert not refresh.refresh_plan(rows, AS_OF).first()["needs_tmdb"]


def test_unchanged_cycles(spark):
    seen = {"x": "abbb", "y": "a", "z": "ab", "u": "aab", "v": "aaa"}
    rows = [(k, i, v) for k, s in seen.items() for i, v in enumerate(s)] + [("n", 0, None), ("n", 1, None)]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    for rows_per_task in (1_000_000, 2, 1):
        got = {r["k"]: r["cycles"] for r in refresh.unchanged_cycles(df, "k", ["at"], ["v"], rows_per_task).collect()}
        assert got == {"x": 2, "y": 0, "z": 0, "u": 0, "v": 2, "n": 1}


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_join_without_a_shuffle(spark, database, no_broadcast):
    name, root = database
    left = spark.range(500).select(F.col("id").alias("tmdb_id"), F.col("id").alias("movie_id"))
    right = spark.range(0, 500, 2).select(F.col("id").alias("tmdb_id"), F.lit("t").alias("title"))
    tables.save_clustered(left, f"{name}.l", f"{root}/l", "tmdb_id", 4)
    tables.save_clustered(right, f"{name}.r", f"{root}/r", "tmdb_id", 4)
    joined = lookup(spark.table(f"{name}.l"), spark.table(f"{name}.r"), "tmdb_id", [("title", "title")])
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert joined.where("title is not null").count() == 250 and joined.count() == 500


def test_rows_without_a_key_are_spread(spark, no_broadcast):
    left = spark.range(1000).select(F.col("id").alias("movie_id"), F.when(F.col("id") < 10, F.lit("a")).alias("imdb_id"))
    right = spark.createDataFrame([("a", 1), ("0", 2)], "imdb_id string, v int")
    joined = lookup(left, right, "imdb_id", [("v", "v")], spread_by="movie_id")
    assert joined.where("v = 1").count() == 10 and joined.where("v is null").count() == 990
    assert "hashpartitioning(__fill" in plan_of(joined) and "__slot" in plan_of(joined)
    zero = left.withColumn("imdb_id", F.lit("0"))
    assert lookup(zero, right, "imdb_id", [("v", "v")], spread_by="movie_id").where("v = 2").count() == 1000


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    from marquee.plans import catalog, derived

    years = plan_of(catalog.QUERIES["year_range"](spark, sf_dir))
    assert "GreaterThanOrEqual(release_date,1997-01-01)" in years and "LessThan(release_date,2000-01-01)" in years
    derived.movies(spark, sf_dir)
    stats = plan_of(catalog.QUERIES["collection_stats"](spark, sf_dir))
    assert "title" not in stats.split("ReadSchema")[1]


def test_hot_key_is_split(spark):
    """Two thirds of the snapshots belong to one key."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"),
        F.when(F.col("id") < 29_000, "a").otherwise("b").alias("v"))
    got = {r["k"]: r["cycles"] for r in refresh.unchanged_cycles(rows, "k", ["at"], ["v"]).collect()}
    assert got[0] == sum(1 for i in range(29_000, 30_000) if i % 3) - 1 and got[3] == 0 and len(got) == 10_000


def test_patch_keeps_key_joins_spread(spark):
    """Bare keys are joined in as many partitions as set, however few bytes they pack into."""
    target = spark.range(100_000).select(F.col("id"), F.lit("a").alias("v"))
    batch = spark.range(50_000, 150_000).select("id", F.lit("b").alias("v"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = mutate.upsert(target, batch, ["id"], "patch")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 150_000 and out.where("v = 'b'").count() == 100_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # Such an exchange is left alone when small partitions are put together.
    assert "REPARTITION_BY_NUM" in plan


def test_stored_tables_grow_in_parts_not_in_part_size(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(derived, "_STORED", {})
    monkeypatch.setattr(derived, "ROWS_PER_PART", 100)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    parts = derived.movies(spark, sf_dir).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in parts) == orders and len(parts) > orders / 100 * 0.8 > 8
    assert max(r["count"] for r in parts) < 300


def test_film_sums_are_hashed_not_sorted(spark, sf_dir):
    rows, _, _ = derived._sources(spark, sf_dir, "tmdb")
    assert "SortAggregate" not in rows._jdf.queryExecution().executedPlan().toString()
    want = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg(F.max("l_linestatus").alias("top"))
    wrong = rows.join(want, "l_orderkey").where("(coalesce(status, '') = 'O') <> (coalesce(top, '') = 'O')")
    assert wrong.count() == 0
