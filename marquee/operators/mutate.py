"""Keyed table changes as frame-to-frame functions, and the versioned tables they are written to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.dates import days_since, stamp, year_bounds
from marquee.functions.dates import FREEZE_MIN_AGE_DAYS, FREEZE_STABLE_CYCLES
from marquee.operators.ranking import with_dense_index


def latest_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the largest by ``order``, then by the other columns.

    An aggregate, not a window: copies of a hot key are merged before the shuffle. Rows with a NULL
    key part are equal to nothing and all stay.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    newest = F.max(F.struct(*order, *rest)).alias("row")
    kept = rows.where(known).groupBy(*keys).agg(newest).select(*keys, "row.*")
    return kept.select(*rows.columns).unionByName(rows.where(~known))


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], mode: str = "replace",
           defaults: Mapping[str, Any] | None = None, order: Sequence[str] = ()) -> DataFrame:
    """The target after inserting ``incoming`` by key.

    ``replace`` drops matching target rows, so columns the batch lacks fall back to ``defaults`` (values or
    column expressions) or NULL. ``patch`` overwrites only the batch's columns. A NULL key matches nothing. Repeated keys in
    the batch are first reduced to the latest by ``order``.
    """
    extra = [c for c in incoming.columns if c not in target.columns]
    if extra:
        raise ValueError(f"columns not in the target: {extra}")
    if mode not in ("replace", "patch"):
        raise ValueError(f"unknown mode: {mode}")
    batch = latest_by_key(incoming, keys, order).select(
        *[F.col(c).cast(target.schema[c].dataType).alias(c) for c in incoming.columns])

    def complete(rows: DataFrame) -> DataFrame:
        filled = {c: F.lit((defaults or {}).get(c)).cast(target.schema[c].dataType)  # lit leaves a column expression as it is
                  for c in target.columns if c not in rows.columns}
        return rows.withColumns(filled).select(*target.columns) if filled else rows.select(*target.columns)

    if mode == "replace":
        kept = target.join(batch.select(*keys), list(keys), "left_anti").select(*target.columns)
        return kept.unionByName(complete(batch))

    # The batch is the small side of every join, so the planner can leave the target unshuffled.
    changed = [c for c in batch.columns if c not in keys]
    side = batch.select(*keys, F.struct(*changed).alias("__new") if changed else F.lit(True).alias("__new"),
                        F.lit(True).alias("__hit"))
    patched = target.join(side, list(keys), "left").select(*[
        F.when(F.col("__hit"), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in target.columns
    ])
    # Bare keys pack into so few bytes that coalescing by size would put millions of them in one task; a shuffle into a
    # given number of partitions is left as it is.
    spread = batch.repartition(int(target.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    present = target.select(*keys).join(spread.select(*keys), list(keys), "left_semi").distinct()
    return patched.unionByName(complete(spread.join(present, list(keys), "left_anti")))


def assign_ids(rows: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """Give rows without an id the next dense ids, in ``order``; existing ids stay."""
    top = rows.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top")).scalar()
    fresh = with_dense_index(rows.where(F.col(id_column).isNull()), [F.asc_nulls_last(c) for c in order], "__n", start=1)
    numbered = fresh.withColumn(id_column, (F.col("__n") + top).cast(rows.schema[id_column].dataType)).drop("__n")
    return rows.where(F.col(id_column).isNotNull()).unionByName(numbered)


def discover_upsert(movies: DataFrame, discovered: DataFrame, mode: str = "replace",
                    defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Upsert a discover batch on tmdb_id, then number the rows that have no movie_id."""
    batch = discovered.select("tmdb_id", "title", F.col("release_date").try_cast("date").alias("release_date"))
    return assign_ids(upsert(movies, batch, ["tmdb_id"], mode, defaults), "movie_id", ["tmdb_id"])


def stamp_updates(table: DataFrame, ids: DataFrame, key: str, column: str, at: dt.datetime) -> DataFrame:
    """Set ``column`` to ``at`` on the rows whose ``key`` occurs in ``ids``."""
    hits = ids.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__hit", F.lit(True))
    return table.join(hits, key, "left").select(*[
        F.when(F.col("__hit"), stamp(at)).otherwise(F.col(c)).alias(c) if c == column else F.col(c)
        for c in table.columns
    ])


def mark_full_refresh(movies: DataFrame, at: dt.datetime) -> DataFrame:
    """Stamp last_full_refresh where both source stamps exist and it is still empty."""
    ready = F.expr("last_tmdb_update is not null and last_omdb_update is not null and last_full_refresh is null")
    return movies.withColumn("last_full_refresh", F.when(ready, stamp(at)).otherwise(F.col("last_full_refresh")))


def set_next_refresh(state: DataFrame, due: DataFrame, at: dt.datetime, defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Record (movie_id, next_refresh_due) rows and when they were checked; other settings stay."""
    batch = due.select("movie_id", "next_refresh_due", stamp(at).alias("last_checked"))
    return upsert(state, batch, ["movie_id"], "patch", defaults)


def should_freeze(release: Column, last_tmdb: Column, last_omdb: Column, cycles: Column, as_of: dt.datetime) -> Column:
    """Old enough, fetched at least once, and unchanged for enough cycles."""
    return F.coalesce(
        (days_since(release, as_of) >= FREEZE_MIN_AGE_DAYS)
        & (last_tmdb.isNotNull() | last_omdb.isNotNull())
        & (cycles >= FREEZE_STABLE_CYCLES),
        F.lit(False),
    )


def apply_freeze(movies: DataFrame, candidates: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Freeze the movies among ``candidates`` that pass the rule.

    ``candidates`` holds the state before the refresh; a ``cycles`` column replaces the assumed three
    unchanged cycles.
    """
    cycles = F.col("cycles") if "cycles" in candidates.columns else F.lit(FREEZE_STABLE_CYCLES)
    passing = candidates.where(should_freeze(
        F.col("release_date"), F.col("last_tmdb_update"), F.col("last_omdb_update"), cycles, as_of))
    return upsert(movies, passing.select("movie_id", F.lit(True).alias("data_frozen")), ["movie_id"], "patch")


def unfreeze(movies: DataFrame, movie_id: int | None = None, year: int | None = None, from_year: int | None = None) -> DataFrame:
    """Clear the frozen flag of one movie, one release year, or every release from a year on."""
    picked = F.lit(False)
    if movie_id is not None:
        picked = picked | (F.col("movie_id") == movie_id)
    if year is not None:
        first, after = year_bounds(year, year)
        picked = picked | ((F.col("release_date") >= first) & (F.col("release_date") < after))
    if from_year is not None:
        picked = picked | (F.col("release_date") >= year_bounds(from_year, from_year)[0])
    return movies.withColumn("data_frozen", F.when(picked, F.lit(False)).otherwise(F.col("data_frozen")))


def force_refresh(movies: DataFrame, tmdb_id: int) -> DataFrame:
    """Clear both source stamps of one movie so that the next cycle picks it up."""
    hit = F.col("tmdb_id") == tmdb_id
    return movies.withColumns({
        c: F.when(hit, F.lit(None)).otherwise(F.col(c)) for c in ("last_tmdb_update", "last_omdb_update")
    })
