"""Queries U1-U8 and R7: keyed table changes and the refresh cycle."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from marquee.operators import cycle, mutate
from marquee.plans.derived import AS_OF, movies, omdb, refresh_state, table, tmdb, with_views
from marquee.plans.refreshes import _DAYS, _DUE, _QUEUE_ORDER, _elapsed
from marquee.plans.registry import query
from marquee.schemas import TABLE_DEFAULTS, table_defaults
from marquee.session import scratch_path
from marquee.sources import tables
from marquee.sources.deltas import DeltaTable

AT = dt.datetime(2001, 8, 2, 13, 0, 0)
_AT = "TIMESTAMP '2001-08-02 13:00:00'"
# A batch of renamed movies, every third of them new; the same rows for both engines.
_RENAMED = {"batch_v": "SELECT CASE WHEN tmdb_id % 3 = 0 THEN tmdb_id + 100000000 ELSE tmdb_id END AS tmdb_id, "
                       "title || ' (renamed)' AS title, release_date FROM movies_v WHERE tmdb_id % 10 = 0"}


def _renamed(spark, sf):
    rows = movies(spark, sf).where("tmdb_id % 10 = 0")
    key = F.when(F.col("tmdb_id") % 3 == 0, F.col("tmdb_id") + 100000000).otherwise(F.col("tmdb_id"))
    return rows.select(key.alias("tmdb_id"), F.concat("title", F.lit(" (renamed)")).alias("title"), "release_date")


_COLUMNS = ["movie_id", "tmdb_id", "imdb_id", "title", "release_date", "created_at", "last_full_refresh", "last_tmdb_update",
            "last_omdb_update", "last_numbers_update", "data_frozen"]
_NEW_ROW = {"tmdb_id": "b.tmdb_id", "title": "b.title", "release_date": "b.release_date",
            "created_at": "TIMESTAMP '2001-08-02 12:00:00'", "data_frozen": "FALSE"}
_REPLACED = (
    "SELECT m.* FROM movies_v m WHERE NOT EXISTS (SELECT 1 FROM batch_v b WHERE b.tmdb_id = m.tmdb_id) UNION ALL SELECT "
    + ", ".join(f"{_NEW_ROW.get(c, 'NULL')} AS {c}" for c in _COLUMNS) + " FROM batch_v b")
_PATCHED = (
    "SELECT " + ", ".join(
        f"CASE WHEN b.tmdb_id IS NOT NULL THEN b.{c} ELSE m.{c} END AS {c}" if c in ("title", "release_date") else f"m.{c}"
        for c in _COLUMNS)
    + " FROM movies_v m LEFT JOIN batch_v b ON b.tmdb_id = m.tmdb_id UNION ALL SELECT "
    + ", ".join(f"{_NEW_ROW.get(c, 'NULL')} AS {c}" for c in _COLUMNS)
    + " FROM batch_v b WHERE NOT EXISTS (SELECT 1 FROM movies_v m WHERE b.tmdb_id = m.tmdb_id)")


@query("upsert", with_views(_REPLACED, **_RENAMED))
def upsert(spark, sf):
    return mutate.upsert(movies(spark, sf), _renamed(spark, sf), ["tmdb_id"], "replace", table_defaults("movies", AS_OF))


@query("upsert_patch", with_views(_PATCHED, **_RENAMED))
def upsert_patch(spark, sf):
    return mutate.upsert(movies(spark, sf), _renamed(spark, sf), ["tmdb_id"], "patch", table_defaults("movies", AS_OF))


@query("upsert_table", with_views(_REPLACED, **_RENAMED))
def upsert_table(spark, sf):
    """The same replacement through a catalog table and its next version."""
    database, root = f"marquee_{uuid.uuid4().hex}", scratch_path(spark, "tables")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'db')}'")
    name = f"{database}.movies"
    tables.write_table(movies(spark, sf), name, root)
    tables.upsert_table(spark, name, _renamed(spark, sf), ["tmdb_id"], root, as_of=AS_OF)
    return spark.table(name)


@query("upsert_bucketed", with_views(
    "SELECT c_custkey, c_name, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer"))
def upsert_bucketed(spark, sf):
    """Only the key buckets of the changed rows are read and rewritten."""
    path = scratch_path(spark, "bucketed")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    tables.write_bucketed(rows, path, ["c_custkey"], 8)
    changed = rows.where("c_custkey % 4 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    tables.upsert_bucketed(spark, path, changed.select("c_custkey", "c_acctbal"), ["c_custkey"], 8, "patch")
    return tables.read_bucketed(spark, path)


@query("upsert_delta", with_views(_REPLACED, **_RENAMED))
def upsert_delta(spark, sf):
    """The same replacement as a versioned change: the batch's rows and a delete vector, merged on read."""
    table = DeltaTable(spark, scratch_path(spark, "delta"))
    table.create(movies(spark, sf), ["tmdb_id"])
    table.upsert(_renamed(spark, sf), "replace", table_defaults("movies", AS_OF))
    return table.read()


@query("delta_versions", with_views(
    "SELECT 0 AS version, * FROM movies_v UNION ALL SELECT 1, * FROM (" + _REPLACED + ") UNION ALL SELECT 2, * FROM (" + _REPLACED + ")", **_RENAMED))
def delta_versions(spark, sf):
    """Every version of a changed and then compacted table, each read from its own manifest."""
    table = DeltaTable(spark, scratch_path(spark, "delta"))
    table.create(movies(spark, sf), ["tmdb_id"])
    table.upsert(_renamed(spark, sf), "replace", table_defaults("movies", AS_OF))
    table.compact()
    return table.read(0).select(F.lit(0).alias("version"), "*").unionByName(table.read(1).select(F.lit(1).alias("version"), "*")).unionByName(
        table.read(2).select(F.lit(2).alias("version"), "*"))


@query("latest_by_key",
       "SELECT user_id, ts, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_by_key(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return mutate.latest_by_key(rows, ["user_id"], ["ts", "event_id"])


@query("assign_ids", with_views(
    "SELECT tmdb_id, CASE WHEN tmdb_id % 4 = 0 THEN (SELECT max(tmdb_id) FROM movies_v WHERE tmdb_id % 4 <> 0) + "
    "row_number() OVER (PARTITION BY tmdb_id % 4 = 0 ORDER BY tmdb_id) ELSE tmdb_id END AS movie_id FROM movies_v"))
def assign_ids(spark, sf):
    rows = movies(spark, sf).select("tmdb_id", F.when(F.col("tmdb_id") % 4 != 0, F.col("tmdb_id")).alias("movie_id"))
    return mutate.assign_ids(rows, "movie_id", ["tmdb_id"])


@query("discover_upsert", with_views(
    "SELECT coalesce(movie_id, (SELECT max(movie_id) FROM replaced_v) + row_number() OVER (PARTITION BY movie_id IS NULL ORDER BY tmdb_id)) "
    "AS movie_id, * EXCLUDE (movie_id) FROM replaced_v", **_RENAMED, replaced_v=_REPLACED))
def discover_upsert(spark, sf):
    batch = _renamed(spark, sf).withColumn("release_date", F.col("release_date").cast("string"))
    return mutate.discover_upsert(movies(spark, sf), batch, "replace", table_defaults("movies", AS_OF))


@query("stamp_updates", with_views(
    f"SELECT * REPLACE (CASE WHEN tmdb_id % 10 = 0 THEN {_AT} ELSE last_tmdb_update END AS last_tmdb_update) FROM movies_v"))
def stamp_updates(spark, sf):
    ids = movies(spark, sf).where("tmdb_id % 10 = 0")
    return mutate.stamp_updates(movies(spark, sf), ids, "tmdb_id", "last_tmdb_update", AT)


@query("mark_full_refresh", with_views(
    "SELECT * REPLACE (CASE WHEN last_tmdb_update IS NOT NULL AND last_omdb_update IS NOT NULL AND last_full_refresh IS NULL "
    f"THEN {_AT} ELSE last_full_refresh END AS last_full_refresh) FROM movies_v"))
def mark_full_refresh(spark, sf):
    return mutate.mark_full_refresh(movies(spark, sf), AT)


_DUE_ROWS = {"due_v": "SELECT movie_id, CAST(release_date + INTERVAL '3650' DAY AS TIMESTAMP) AS next_refresh_due FROM movies_v WHERE movie_id % 6 = 1"}


@query("set_next_refresh", with_views(
    "SELECT s.* REPLACE (CASE WHEN d.movie_id IS NOT NULL THEN d.next_refresh_due ELSE s.next_refresh_due END AS next_refresh_due, "
    f"CASE WHEN d.movie_id IS NOT NULL THEN {_AT} ELSE s.last_checked END AS last_checked) FROM state_v s LEFT JOIN due_v d USING (movie_id) "
    f"UNION ALL SELECT movie_id, 30, next_refresh_due, 365, FALSE, {_AT} FROM due_v d WHERE movie_id NOT IN (SELECT movie_id FROM state_v)",
    **_DUE_ROWS))
def set_next_refresh(spark, sf):
    due = movies(spark, sf).where("movie_id % 6 = 1").select(
        "movie_id", F.date_add("release_date", 3650).cast("timestamp_ntz").alias("next_refresh_due"))
    return mutate.set_next_refresh(refresh_state(spark, sf), due, AT, TABLE_DEFAULTS["movie_refresh_state"])


_FREEZE = f"coalesce({_DAYS} >= 365 AND (last_tmdb_update IS NOT NULL OR last_omdb_update IS NOT NULL), FALSE)"


@query("apply_freeze", with_views(
    f"SELECT * REPLACE (CASE WHEN {_FREEZE} AND movie_id % 2 = 0 THEN TRUE ELSE data_frozen END AS data_frozen) FROM movies_v"))
def apply_freeze(spark, sf):
    return mutate.apply_freeze(movies(spark, sf), movies(spark, sf).where("movie_id % 2 = 0"), AS_OF)


@query("unfreeze", with_views(
    "SELECT * REPLACE (CASE WHEN movie_id = 12 OR year(release_date) = 1997 OR year(release_date) >= 2000 THEN FALSE ELSE data_frozen END "
    "AS data_frozen) FROM movies_v"))
def unfreeze(spark, sf):
    return mutate.unfreeze(movies(spark, sf), movie_id=12, year=1997, from_year=2000)


@query("force_refresh", with_views(
    "SELECT * REPLACE (CASE WHEN tmdb_id = 7 THEN NULL ELSE last_tmdb_update END AS last_tmdb_update, "
    "CASE WHEN tmdb_id = 7 THEN NULL ELSE last_omdb_update END AS last_omdb_update) FROM movies_v"))
def force_refresh(spark, sf):
    return mutate.force_refresh(movies(spark, sf), 7)


_CYCLE = {
    "queue_v": f"SELECT *, {_elapsed('tmdb')} AS needs_tmdb, {_elapsed('omdb')} AS needs_omdb, {_FREEZE} AS freezes FROM movies_v "
               f"WHERE data_frozen = FALSE AND {_DUE} ORDER BY {_QUEUE_ORDER} LIMIT 200",
    # Every TMDB row and every OMDB row is landed again.
    "got_v": "SELECT tmdb_id FROM tmdb_v WHERE tmdb_id IN (SELECT tmdb_id FROM queue_v WHERE needs_tmdb)",
    "want_v": "SELECT DISTINCT t.imdb_id FROM tmdb_v t JOIN queue_v q ON t.tmdb_id = q.tmdb_id WHERE q.needs_omdb AND t.imdb_id <> ''",
    "title_v": "SELECT imdb_id FROM omdb_v WHERE imdb_id IN (SELECT imdb_id FROM want_v)",
    "id_v": "SELECT m.movie_id, coalesce(m.imdb_id, nullif(t.imdb_id, '')) AS imdb_id FROM movies_v m LEFT JOIN tmdb_v t ON m.tmdb_id = t.tmdb_id",
    "stamped_v": "SELECT m.* REPLACE ("
                 f"CASE WHEN m.tmdb_id IN (SELECT tmdb_id FROM got_v) THEN {_AT} ELSE m.last_tmdb_update END AS last_tmdb_update, "
                 "CASE WHEN m.movie_id IN (SELECT movie_id FROM id_v WHERE imdb_id IN (SELECT imdb_id FROM title_v)) "
                 f"THEN {_AT} ELSE m.last_omdb_update END AS last_omdb_update, "
                 "CASE WHEN m.movie_id IN (SELECT movie_id FROM queue_v WHERE freezes) THEN TRUE ELSE m.data_frozen END AS data_frozen) FROM movies_v m",
}


@query("refresh_cycle", with_views(
    "SELECT * REPLACE (CASE WHEN last_tmdb_update IS NOT NULL AND last_omdb_update IS NOT NULL AND last_full_refresh IS NULL "
    f"THEN {_AT} ELSE last_full_refresh END AS last_full_refresh) FROM stamped_v", **{
        k: v.replace("13:00:00", "12:00:00") for k, v in _CYCLE.items()}).replace("13:00:00", "12:00:00"))
def refresh_cycle(spark, sf):
    """The movies table after one cycle in which both sources answer for everything asked."""
    args = [f(spark, sf) for f in (movies, tmdb, omdb)]
    return cycle.refresh_cycle(*args, landed_details=tmdb(spark, sf), landed_titles=omdb(spark, sf), as_of=AS_OF, limit=200).movies
