"""One refresh cycle over the movie tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from marquee.operators.joins import imdb_ids_for, resolve_imdb_id
from marquee.operators.mutate import apply_freeze, mark_full_refresh, should_freeze, stamp_updates, upsert
from marquee.operators.refresh import due_queue, due_rows, refresh_plan
from marquee.functions.dates import FREEZE_STABLE_CYCLES
from marquee.session import materialize


@dataclass
class CycleResult:
    movies: DataFrame
    tmdb: DataFrame
    omdb: DataFrame
    tmdb_updated: int
    omdb_updated: int
    frozen: int


def refresh_cycle(movies: DataFrame, tmdb: DataFrame, omdb: DataFrame, landed_details: DataFrame,
                  landed_titles: DataFrame, as_of: dt.datetime, limit: int | None = 100) -> CycleResult:
    """Plan, take the landed rows the plan asks for, upsert, stamp, mark full refreshes, freeze.

    ``landed_details`` and ``landed_titles`` are normalised rows (see ``marquee.sources.payloads``).
    The due movies and both batches are written once, because several results read them.
    """
    queue = due_rows(movies, as_of) if limit is None else due_queue(movies, as_of, limit)
    plan = refresh_plan(queue, as_of).select("movie_id", "needs_tmdb", "needs_omdb")
    due = materialize(queue.join(plan, "movie_id"), "due")

    details = materialize(
        landed_details.join(due.where("needs_tmdb").select("tmdb_id"), "tmdb_id", "left_semi"), "details")
    new_tmdb = upsert(tmdb, details, ["tmdb_id"], "replace", order=["last_updated_utc"])

    wanted = imdb_ids_for(due.where("needs_omdb"), new_tmdb)
    titles = materialize(landed_titles.join(wanted, "imdb_id", "left_semi"), "titles")
    new_omdb = upsert(omdb, titles, ["imdb_id"], "replace", order=["last_updated_utc"])

    tmdb_updated, omdb_updated = details.count(), titles.count()
    out = stamp_updates(movies, details, "tmdb_id", "last_tmdb_update", as_of)
    # Title rows are matched through the resolved id, as movies may not carry one of their own.
    ids = resolve_imdb_id(movies.select("movie_id", "tmdb_id", "imdb_id"), new_tmdb)
    fetched = ids.join(titles.select("imdb_id"), "imdb_id", "left_semi").select("movie_id")
    out = stamp_updates(out, fetched, "movie_id", "last_omdb_update", as_of)
    if tmdb_updated and omdb_updated:
        out = mark_full_refresh(out, as_of)
    out = apply_freeze(out, due, as_of)
    frozen = due.where(should_freeze(
        F.col("release_date"), F.col("last_tmdb_update"), F.col("last_omdb_update"), F.lit(FREEZE_STABLE_CYCLES),
        as_of)).count()
    return CycleResult(out, new_tmdb, new_omdb, tmdb_updated, omdb_updated, frozen)
