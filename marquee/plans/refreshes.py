"""Queries R1-R14: refresh analytics."""

from pyspark.sql import functions as F

from marquee.functions.dates import INTERVALS
from marquee.operators import mutate, refresh
from marquee.plans.derived import AS_OF, movies, table, with_views
from marquee.plans.registry import query

_NOW = "TIMESTAMP '2001-08-02 12:00:00'"
_TODAY = "DATE '2001-08-02'"
_DAYS = f"datediff('day', release_date, {_TODAY})"
_AGE = (f"CASE WHEN {_DAYS} <= 60 THEN 'recent' WHEN {_DAYS} <= 180 THEN 'established' WHEN {_DAYS} <= 365 THEN 'mature' "
        f"WHEN {_DAYS} > 365 THEN 'archived' END")


def _interval(source: str) -> str:
    cases = " ".join(f"WHEN '{age}' THEN {days}" for age, days in INTERVALS[source].items())
    return f"CASE {_AGE} {cases} END"


def _elapsed(source: str) -> str:
    return (f"CASE WHEN release_date IS NULL THEN FALSE ELSE last_{source}_update IS NULL OR last_{source}_update < "
            f"{_NOW} - CAST({_interval(source)} AS INT) * INTERVAL '1' DAY END")


def _calendar(source: str) -> str:
    return (f"(last_{source}_update IS NULL OR datediff('day', CAST(last_{source}_update AS DATE), {_TODAY}) >= {_interval(source)})")


_DUE = f"(last_full_refresh IS NULL OR (release_date IS NOT NULL AND ({_calendar('tmdb')} OR {_calendar('omdb')})))"
_DUE_COLUMNS = ("movie_id, tmdb_id, imdb_id, title, release_date, last_full_refresh, last_tmdb_update, last_omdb_update, "
                f"last_numbers_update, data_frozen, CAST({_DAYS} AS INT) AS days_since_release")
_QUEUE_ORDER = "CASE WHEN last_full_refresh IS NULL THEN 0 ELSE 1 END, release_date DESC NULLS LAST, movie_id"


@query("age_category", with_views(f"SELECT movie_id, release_date, {_AGE} AS age_category FROM movies_v"))
def age_category(spark, sf):
    return refresh.age_categories(movies(spark, sf), AS_OF)


@query("refresh_interval", with_views(
    f"SELECT movie_id, {_AGE} AS age_category, " + ", ".join(f"CAST({_interval(s)} AS INT) AS {s}_interval" for s in INTERVALS)
    + " FROM movies_v"))
def refresh_interval(spark, sf):
    return refresh.refresh_intervals(movies(spark, sf), AS_OF)


@query("needs_refresh", with_views(
    f"SELECT movie_id, {_elapsed('tmdb')} AS needs_tmdb FROM movies_v"))
def needs_refresh(spark, sf):
    return movies(spark, sf).select(
        "movie_id", refresh.needs_refresh("release_date", "last_tmdb_update", "tmdb", AS_OF).alias("needs_tmdb"))


@query("refresh_plan", with_views(
    "SELECT movie_id, tmdb_id, " + ", ".join(f"{_elapsed(s)} AS needs_{s}" for s in INTERVALS) + " FROM movies_v"))
def refresh_plan(spark, sf):
    return refresh.refresh_plan(movies(spark, sf), AS_OF)


@query("due_queue", with_views(f"SELECT {_DUE_COLUMNS} FROM movies_v WHERE data_frozen = FALSE AND {_DUE}"))
def due_queue(spark, sf):
    return refresh.due_queue(movies(spark, sf), AS_OF)


@query("due_queue_top", with_views(f"SELECT {_DUE_COLUMNS} FROM movies_v WHERE {_DUE} ORDER BY {_QUEUE_ORDER} LIMIT 100"))
def due_queue_top(spark, sf):
    return refresh.due_queue(movies(spark, sf), AS_OF, limit=100, include_frozen=True)


@query("should_freeze", with_views(
    f"SELECT movie_id, coalesce({_DAYS} >= 365 AND (last_tmdb_update IS NOT NULL OR last_omdb_update IS NOT NULL) "
    "AND movie_id % 5 >= 3, FALSE) AS freeze FROM movies_v"))
def should_freeze(spark, sf):
    cycles = F.col("movie_id") % 5
    return movies(spark, sf).select("movie_id", mutate.should_freeze(
        F.col("release_date"), F.col("last_tmdb_update"), F.col("last_omdb_update"), cycles, AS_OF).alias("freeze"))


@query("collection_stats", with_views(
    "SELECT count(DISTINCT movie_id) AS total_movies, "
    + ", ".join(f"count(DISTINCT CASE WHEN {c} THEN movie_id END) AS {n}" for n, c in {
        "with_tmdb": "last_tmdb_update IS NOT NULL", "with_omdb": "last_omdb_update IS NOT NULL",
        "fully_refreshed": "last_full_refresh IS NOT NULL", "frozen": "data_frozen = TRUE",
        "recent_movies": f"release_date >= {_TODAY} - INTERVAL '60' DAY",
        "established_movies": f"release_date < {_TODAY} - INTERVAL '60' DAY AND release_date >= {_TODAY} - INTERVAL '180' DAY",
        "mature_movies": f"release_date < {_TODAY} - INTERVAL '180' DAY AND release_date >= {_TODAY} - INTERVAL '365' DAY",
        "archived_movies": f"release_date < {_TODAY} - INTERVAL '365' DAY"}.items())
    + " FROM movies_v"))
def collection_stats(spark, sf):
    return refresh.collection_stats(movies(spark, sf), AS_OF)


@query("age_distribution", with_views(
    f"SELECT coalesce({_AGE}, 'unknown') AS category, count(*) AS count FROM movies_v GROUP BY 1"))
def age_distribution(spark, sf):
    return refresh.age_distribution(movies(spark, sf), AS_OF)


def _fresh(source: str) -> str:
    return (f"round(avg(CASE WHEN datediff('day', CAST(last_{source}_update AS DATE), {_TODAY}) <= {_interval(source)} "
            f"THEN 1 ELSE 0 END) * 100, 6) AS {source}_pct")


@query("coverage_pct", with_views(
    f"SELECT {_fresh('tmdb')}, {_fresh('omdb')}, count(*) FILTER (data_frozen) AS frozen_count, "
    "round(count(*) FILTER (data_frozen) / count(*) * 100, 6) AS frozen_pct FROM movies_v"))
def coverage_pct(spark, sf):
    rows = refresh.coverage_pct(movies(spark, sf), AS_OF)
    return rows.withColumns({c: F.round(c, 6) for c in ("tmdb_pct", "omdb_pct", "frozen_pct")})


@query("due_count_by_age", with_views(
    f"SELECT {_AGE} AS age_category, count(*) AS movies, "
    + ", ".join(f"count(*) FILTER ({_calendar(s)}) AS {s}_due" for s in INTERVALS)
    + " FROM movies_v WHERE data_frozen = FALSE AND release_date IS NOT NULL GROUP BY 1"))
def due_count_by_age(spark, sf):
    return refresh.due_count_by_age(movies(spark, sf), AS_OF)


@query("staleness_checks", with_views(
    "SELECT count(*) FILTER (last_full_refresh IS NULL) AS never_refreshed, "
    f"count(*) FILTER (last_tmdb_update < {_TODAY} - INTERVAL '30' DAY) AS stale_tmdb, "
    f"count(*) FILTER ({_DAYS} > 365 AND data_frozen = FALSE) AS old_unfrozen FROM movies_v"))
def staleness_checks(spark, sf):
    return refresh.staleness_counts(movies(spark, sf), AS_OF)


@query("last_updates", with_views(
    "SELECT movie_id, title, release_date, last_tmdb_update, "
    f"CAST(datediff('day', CAST(last_tmdb_update AS DATE), {_TODAY}) AS INT) AS days_since_update FROM movies_v "
    "WHERE last_tmdb_update IS NOT NULL ORDER BY last_tmdb_update DESC, movie_id LIMIT 10"))
def last_updates(spark, sf):
    return refresh.last_updates(movies(spark, sf), AS_OF)


@query("old_unfrozen", with_views(
    f"SELECT movie_id, title, release_date, CAST({_DAYS} AS INT) AS age_days, last_tmdb_update, last_omdb_update, data_frozen "
    f"FROM movies_v WHERE {_DAYS} > 365 AND data_frozen = FALSE ORDER BY movie_id LIMIT 10"))
def old_unfrozen(spark, sf):
    return refresh.old_unfrozen(movies(spark, sf), AS_OF)


@query("never_refreshed", with_views(
    f"SELECT movie_id, title, release_date, last_tmdb_update, last_omdb_update, CAST({_DAYS} AS INT) AS age_days "
    "FROM movies_v WHERE data_frozen = FALSE AND last_full_refresh IS NULL ORDER BY movie_id LIMIT 10"))
def never_refreshed(spark, sf):
    return refresh.never_refreshed(movies(spark, sf), AS_OF)


@query("unchanged_cycles",
       "WITH s AS (SELECT user_id, event_id, ts, CASE event_type WHEN 'error' THEN NULL ELSE 'ok' END AS state FROM events), "
       "n AS (SELECT user_id, arg_max_null(state, (ts, event_id)) AS newest FROM s GROUP BY user_id), "
       "c AS (SELECT s.user_id, max((s.ts, s.event_id)) AS changed FROM s JOIN n USING (user_id) "
       "WHERE s.state IS DISTINCT FROM n.newest GROUP BY s.user_id) "
       "SELECT s.user_id, count(*) - 1 AS cycles FROM s LEFT JOIN c USING (user_id) "
       "WHERE c.changed IS NULL OR (s.ts, s.event_id) > c.changed GROUP BY s.user_id")
def unchanged_cycles(spark, sf):
    state = F.when(F.col("event_type") != "error", "ok")
    return refresh.unchanged_cycles(
        table(spark, sf, "events").withColumn("state", state), "user_id", ["ts", "event_id"], ["state"])


@query("dispatch_plan", with_views(
    "SELECT movie_id, pos AS queue_pos, CAST(floor(pos / 50) AS BIGINT) AS batch, pos / 4.0 AS start_offset_sec FROM ("
    f"SELECT movie_id, row_number() OVER (ORDER BY {_QUEUE_ORDER}) - 1 AS pos FROM movies_v WHERE data_frozen = FALSE AND {_DUE})"))
def dispatch_plan(spark, sf):
    plan = refresh.dispatch_plan(refresh.due_rows(movies(spark, sf), AS_OF), refresh.queue_order())
    return plan.select("movie_id", "queue_pos", "batch", "start_offset_sec")
