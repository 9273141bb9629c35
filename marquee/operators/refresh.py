"""Which movies are due for a refresh, and how well the collection is covered."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.functions.dates import INTERVALS, age_category, days_since, refresh_interval, stamp, today
from marquee.operators.ranking import with_dense_index

SOURCE_STAMPS = {source: f"last_{source}_update" for source in INTERVALS}
AGES = ("recent", "established", "mature", "archived")


def age_categories(movies: DataFrame, as_of: dt.datetime) -> DataFrame:
    return movies.select("movie_id", "release_date", age_category("release_date", as_of).alias("age_category"))


def refresh_intervals(movies: DataFrame, as_of: dt.datetime) -> DataFrame:
    return movies.select("movie_id", age_category("release_date", as_of).alias("age_category"), *[
        refresh_interval("release_date", s, as_of).alias(f"{s}_interval") for s in INTERVALS])


def needs_refresh(release: Column | str, last: Column | str, source: str, as_of: dt.datetime) -> Column:
    """Never updated, or strictly longer ago than the interval in elapsed time.

    False without a release date.
    """
    last = F.col(last) if isinstance(last, str) else last
    limit = stamp(as_of) - F.make_dt_interval(refresh_interval(release, source, as_of))
    release = F.col(release) if isinstance(release, str) else release
    return F.when(release.isNull(), False).otherwise(last.isNull() | (last < limit))


def refresh_plan(movies: DataFrame, as_of: dt.datetime) -> DataFrame:
    return movies.select("movie_id", "tmdb_id", *[
        needs_refresh("release_date", column, source, as_of).alias(f"needs_{source}")
        for source, column in SOURCE_STAMPS.items()])


def _due_by_calendar(as_of: dt.datetime) -> Column:
    stale = [
        F.col(SOURCE_STAMPS[s]).isNull()
        | (days_since(SOURCE_STAMPS[s], as_of) >= refresh_interval("release_date", s, as_of))
        for s in ("tmdb", "omdb")
    ]
    return F.col("last_full_refresh").isNull() | (F.col("release_date").isNotNull() & (stale[0] | stale[1]))


def due_rows(movies: DataFrame, as_of: dt.datetime, include_frozen: bool = False) -> DataFrame:
    """Movies due by calendar days, unordered."""
    rows = movies if include_frozen else movies.where("data_frozen = false")
    return rows.where(_due_by_calendar(as_of)).select(
        "movie_id", "tmdb_id", "imdb_id", "title", "release_date", "last_full_refresh", "last_tmdb_update",
        "last_omdb_update", "last_numbers_update", "data_frozen",
        days_since("release_date", as_of).alias("days_since_release"))


def queue_order() -> list[Column]:
    """Never refreshed first, then newest release, then id."""
    return [F.col("last_full_refresh").isNotNull(), F.desc_nulls_last("release_date"), F.col("movie_id")]


def due_queue(movies: DataFrame, as_of: dt.datetime, limit: int | None = None, include_frozen: bool = False) -> DataFrame:
    rows = due_rows(movies, as_of, include_frozen).orderBy(*queue_order())
    return rows if limit is None else rows.limit(limit)


def collection_stats(movies: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Counts by fetch state and age. movie_id is the key, so plain conditional counts suffice."""
    age = age_category("release_date", as_of)
    return movies.agg(
        F.count("movie_id").alias("total_movies"),
        F.count_if(F.expr("last_tmdb_update is not null")).alias("with_tmdb"),
        F.count_if(F.expr("last_omdb_update is not null")).alias("with_omdb"),
        F.count_if(F.expr("last_full_refresh is not null")).alias("fully_refreshed"),
        F.count_if("data_frozen").alias("frozen"),
        *[F.count_if(age == a).alias(f"{a}_movies") for a in AGES],
    )


def age_distribution(movies: DataFrame, as_of: dt.datetime, missing: str = "unknown") -> DataFrame:
    """Movies per age bucket; rows without a date count as ``missing``."""
    bucket = F.coalesce(age_category("release_date", as_of), F.lit(missing))
    return movies.groupBy(bucket.alias("category")).agg(F.count("*").alias("count"))


def coverage_pct(movies: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Share updated within their own interval, per source, and share frozen; in percent."""
    def percent(condition: Column) -> Column:
        return F.avg(F.coalesce(condition, F.lit(False)).cast("int")) * 100

    fresh = {
        s: days_since(SOURCE_STAMPS[s], as_of) <= refresh_interval("release_date", s, as_of) for s in ("tmdb", "omdb")
    }
    return movies.agg(
        *[percent(c).alias(f"{s}_pct") for s, c in fresh.items()],
        F.count_if("data_frozen").alias("frozen_count"),
        percent(F.col("data_frozen")).alias("frozen_pct"),
    )


def due_count_by_age(movies: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Unfrozen movies per age, and how many of them each source is due for."""
    plan = {
        s: F.col(SOURCE_STAMPS[s]).isNull()
        | (days_since(SOURCE_STAMPS[s], as_of) >= refresh_interval("release_date", s, as_of)) for s in INTERVALS
    }
    return (
        movies.where("data_frozen = false and release_date is not null")
        .groupBy(age_category("release_date", as_of).alias("age_category"))
        .agg(F.count("*").alias("movies"), *[F.count_if(c).alias(f"{s}_due") for s, c in plan.items()])
    )


def staleness_counts(movies: DataFrame, as_of: dt.datetime, stale_days: int = 30) -> DataFrame:
    """Never refreshed; TMDB stamp older than ``stale_days``; unfrozen and past the freeze age."""
    oldest = F.date_sub(today(as_of), stale_days).cast("timestamp_ntz")
    return movies.agg(
        F.count_if(F.expr("last_full_refresh is null")).alias("never_refreshed"),
        F.count_if(F.col("last_tmdb_update") < oldest).alias("stale_tmdb"),
        F.count_if((days_since("release_date", as_of) > 365) & ~F.col("data_frozen")).alias("old_unfrozen"),
    )


def last_updates(movies: DataFrame, as_of: dt.datetime, n: int = 10) -> DataFrame:
    """The n latest TMDB updates with their age in days."""
    return (
        movies.where("last_tmdb_update is not null").orderBy(F.desc("last_tmdb_update"), "movie_id").limit(n)
        .select("movie_id", "title", "release_date", "last_tmdb_update",
                days_since("last_tmdb_update", as_of).alias("days_since_update"))
    )


def old_unfrozen(movies: DataFrame, as_of: dt.datetime, n: int = 10) -> DataFrame:
    """The n oldest-id movies past the freeze age that are not frozen."""
    return (
        # A bound on the column itself reaches the scan.
        movies.where((F.col("release_date") < F.date_sub(today(as_of), 365)) & ~F.col("data_frozen")).orderBy("movie_id").limit(n)
        .select("movie_id", "title", "release_date", days_since("release_date", as_of).alias("age_days"),
                "last_tmdb_update", "last_omdb_update", "data_frozen")
    )


def never_refreshed(movies: DataFrame, as_of: dt.datetime, n: int = 10) -> DataFrame:
    """The first n unfrozen movies that never had a full refresh."""
    return (
        movies.where("data_frozen = false and last_full_refresh is null").orderBy("movie_id").limit(n)
        .select("movie_id", "title", "release_date", "last_tmdb_update", "last_omdb_update",
                days_since("release_date", as_of).alias("age_days"))
    )


#: Rows of one key that one task takes; a key with more is spread over as many slots as that needs.
ROWS_PER_TASK = 1_000_000


def unchanged_cycles(snapshots: DataFrame, key: str, order: Sequence[str], payload: Sequence[str],
                     rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per key, how many of the latest snapshots repeat the one before them without a gap.

    The trailing run starts after the last snapshot whose payload differs from the newest one: the
    runner-up among the payloads' last dates. Then the snapshots after that date are counted. No key's
    history is gathered in one task: payloads are merged before the shuffle, the runner-up comes from a
    top-2 that is also cut before it, and the counting join is salted for hot keys. Payloads compare
    NULL-safe; ``order`` must be total within a key.
    """
    rows = snapshots.where(F.col(key).isNotNull()).select(
        F.col(key), F.struct(*order).alias("at"), F.struct(*payload).alias("payload"))
    last = rows.groupBy(key, "payload").agg(F.max("at").alias("at"), F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("at")))
    top = last.select(key, "at", place.alias("place")).where("place <= 2")
    changes = top.groupBy(key).agg(F.max(F.when(F.col("place") == 2, F.col("at"))).alias("changed_at"))

    # Keys above one task's share are few and small as rows; the planner broadcasts them while they fit, and the join
    # that meets them otherwise splits by size.
    sizes = last.groupBy(key).agg(F.sum("n").alias("size")).where(F.col("size") > rows_per_task)
    hot = sizes.select(key, F.ceil(F.col("size") / rows_per_task).cast("int").alias("__slots"))
    salted = rows.select(key, "at").join(hot, key, "left").withColumn(
        "__slot", F.pmod(F.hash("at"), F.coalesce("__slots", F.lit(1))))
    copies = changes.join(hot, key, "left").withColumn(
        "__slot", F.explode(F.sequence(F.lit(0), F.coalesce("__slots", F.lit(1)) - 1)))
    counted = salted.drop("__slots").join(copies.drop("__slots"), [key, "__slot"])
    repeats = F.count_if(F.col("changed_at").isNull() | (F.col("at") > F.col("changed_at"))) - 1
    return counted.groupBy(key).agg(repeats.alias("cycles"))


def dispatch_plan(queue: DataFrame, order: Sequence[Column], batch_size: int = 50, per_second: float = 4.0) -> DataFrame:
    """Batch number and earliest start offset in seconds for every queued row."""
    numbered = with_dense_index(queue, order, "queue_pos")
    return numbered.withColumns({
        "batch": F.floor(F.col("queue_pos") / batch_size),
        "start_offset_sec": F.col("queue_pos") / F.lit(float(per_second)),
    })
