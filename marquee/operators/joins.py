"""Star joins, filters and top-k queries over the movie tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from marquee.functions.dates import days_since, stamp, year_bounds
from marquee.functions.text import contains_text

# The columns each source adds to the star, as (source column, output column).
STAR_TMDB = [
    ("title", "tmdb_title"), ("overview", "overview"), ("popularity", "popularity"),
    ("vote_average", "tmdb_vote_average"), ("vote_count", "tmdb_vote_count"), ("budget", "tmdb_budget"),
    ("revenue", "tmdb_revenue"), ("runtime", "tmdb_runtime"), ("status", "status"), ("genres", "genre_names"),
    ("production_companies", "production_company_name"), ("production_countries", "production_country_name"),
    ("spoken_languages", "spoken_languages"),
]
STAR_OMDB = [
    ("rated", "rated"), ("released", "released"), ("runtime", "omdb_runtime"), ("genre", "omdb_genre"),
    ("director", "director"), ("writer", "writer"), ("actors", "actors"), ("language", "language"),
    ("country", "country"), ("awards", "awards"), ("metascore", "metascore"), ("imdb_rating", "imdb_rating"),
    ("imdb_votes", "imdb_votes"), ("box_office", "box_office"),
    ("rotten_tomatoes_rating", "rotten_tomatoes_rating"), ("meta_critic_rating", "meta_critic_rating"),
]
STAR_NUMBERS = [
    ("production_budget", "production_budget"), ("domestic_box_office", "domestic_gross"),
    ("worldwide_box_office", "worldwide_gross"),
]
FINANCIAL_TMDB = [
    ("title", "tmdb_title"), ("popularity", "popularity"), ("vote_average", "vote_average"),
    ("vote_count", "vote_count"), ("runtime", "runtime"), ("genres", "genre_names"), ("budget", "budget"),
    ("revenue", "revenue"),
]
FINANCIAL_OMDB = [
    ("director", "director"), ("writer", "writer"), ("actors", "actors"), ("imdb_rating", "imdb_rating"),
    ("imdb_votes", "imdb_votes"), ("metascore", "metascore"), ("rotten_tomatoes_rating", "rotten_tomatoes_rating"),
]
# Names the modelling steps use for star columns.
MODELING_NAMES = {
    "tmdb_budget": "budget", "tmdb_revenue": "revenue", "popularity": "tmdb_popularity", "rated": "age_rating",
}
EPOCH = dt.datetime(1970, 1, 1)


def lookup(left: DataFrame, right: DataFrame, key: str, columns: Sequence[tuple[str, str]], how: str = "left",
           spread_by: str | None = None) -> DataFrame:
    """Add ``columns`` of ``right``, matched on ``key``, to ``left``.

    No hint: the planner broadcasts ``right`` only when its measured size is below the session's
    limit, and the adaptive skew join splits hot keys. ``spread_by`` names a column of ``left`` to
    spread rows without a key by; they match nothing, yet a shuffle on the bare key would put them all
    in one task.
    """
    added = right.selectExpr(f"`{key}` AS __key", *[f"`{c}` AS `__r_{out}`" for c, out in columns])
    kept = [f"`{c}`" for c in left.columns]
    condition = F.expr(f"`{key}` = __key")
    if spread_by and how == "left":
        # Slot 0 is the only one on the right, so keyless rows in slots 1..1024 stay unmatched.
        kind = left.schema[key].dataType.simpleString()
        left = left.selectExpr(
            "*", f"CASE WHEN `{key}` IS NULL THEN pmod(hash(`{spread_by}`), 1024) + 1 ELSE 0 END AS __slot",
            f"coalesce(`{key}`, CAST('0' AS {kind})) AS __fill")
        added = added.selectExpr("*", "0 AS __rslot")
        condition = F.expr("__fill = __key AND __slot = __rslot")
    return left.join(added, condition, how).selectExpr(*kept, *[f"`__r_{out}` AS `{out}`" for _, out in columns])


def latest_numbers(numbers: DataFrame) -> DataFrame:
    """One row per movie: the most recently updated, ties by the larger values."""
    rest = [c for c in numbers.columns if c not in ("movie_id", "last_updated_utc")]
    newest = F.max(F.struct(F.col("last_updated_utc"), *rest)).alias("row")
    return numbers.groupBy("movie_id").agg(newest).select("movie_id", "row.*")


def full_dataset(movies: DataFrame, tmdb: DataFrame, omdb: DataFrame, numbers: DataFrame,
                 include_nulls: bool = True, one_row_per_movie: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Movies with all source columns. Repeated numbers rows fan out unless ``one_row_per_movie``.

    With ``columns`` only the sources that give one of them are joined, except that repeated numbers rows fan out all
    the same. The other sources are keyed and add no rows.
    """
    def asked(listed: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
        return [(c, out) for c, out in listed if columns is None or out in columns]

    if one_row_per_movie:
        numbers = latest_numbers(numbers)
    star = movies
    filters = [] if include_nulls else [(c, out) for c, out in STAR_TMDB if out in ("tmdb_budget", "tmdb_revenue")]
    if wanted := [pair for pair in STAR_TMDB if pair in asked(STAR_TMDB) or pair in filters]:
        star = lookup(star, tmdb, "tmdb_id", wanted)
    if not include_nulls:
        star = star.where("tmdb_budget is not null and tmdb_revenue is not null")
    if wanted := asked(STAR_OMDB):
        star = lookup(star, omdb, "imdb_id", wanted, spread_by="movie_id")
    if (wanted := asked(STAR_NUMBERS)) or not one_row_per_movie:
        star = lookup(star, numbers, "movie_id", wanted)
    return star if columns is None else star.select(*columns)


def modeling_view(star: DataFrame) -> DataFrame:
    """Star columns under the names the modelling steps use."""
    if "tmdb_runtime" in star.columns:
        star = star.withColumn("runtime_in_min", F.coalesce("tmdb_runtime", "omdb_runtime")).drop("tmdb_runtime", "omdb_runtime")
    return star.withColumnsRenamed(MODELING_NAMES)


def star_columns(modeling: Sequence[str]) -> list[str]:
    """The star columns that the given columns of the modelling view are made of."""
    original = {new: old for old, new in MODELING_NAMES.items()}
    out = [original.get(c, c) for c in modeling if c != "runtime_in_min"]
    return out + (["tmdb_runtime", "omdb_runtime"] if "runtime_in_min" in modeling else [])


def resolve_imdb_id(movies: DataFrame, tmdb: DataFrame) -> DataFrame:
    """Fill a movie's missing IMDb id from its TMDB row; empty text counts as missing."""
    joined = lookup(movies, tmdb, "tmdb_id", [("imdb_id", "__imdb")])
    return joined.withColumn("imdb_id", F.coalesce("imdb_id", F.nullif(F.col("__imdb"), F.lit("")))).drop("__imdb")


def imdb_ids_for(movies: DataFrame, tmdb: DataFrame) -> DataFrame:
    """Distinct non-empty IMDb ids of the TMDB rows that belong to ``movies``."""
    return tmdb.where("imdb_id <> ''").join(movies, "tmdb_id", "left_semi").select("imdb_id").distinct()


def financials(movies: DataFrame, tmdb: DataFrame, omdb: DataFrame, min_budget: float = 0, min_revenue: float = 0) -> DataFrame:
    """Movies with budget and revenue at or above the bounds, newest first."""
    priced = tmdb.where((F.col("budget") >= min_budget) & (F.col("revenue") >= min_revenue))
    rows = lookup(lookup(movies, priced, "tmdb_id", FINANCIAL_TMDB, "inner"), omdb, "imdb_id", FINANCIAL_OMDB,
                  spread_by="movie_id")
    return rows.orderBy(F.desc_nulls_last("release_date"), "movie_id")


def query_movies(movies: DataFrame, filters: Mapping[str, Any] | None = None, columns: Sequence[str] | None = None,
                 limit: int | None = None, order_by: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """Equality filters, ordering as (column, descending), limit and projection."""
    rows = movies
    for name, value in (filters or {}).items():
        rows = rows.where(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    if order_by:
        rows = rows.orderBy(*[F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, down in order_by])
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(*columns) if columns else rows


def by_year_range(movies: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """Movies released in the years start..end, newest first. Plain date bounds, so the scan can skip."""
    first, after = year_bounds(start, end or start)
    return movies.where((F.col("release_date") >= first) & (F.col("release_date") < after)).orderBy(
        F.desc("release_date"), "movie_id")


def refresh_state_due(movies: DataFrame, state: DataFrame, as_of: dt.datetime, limit: int | None = 1000) -> DataFrame:
    """Movies whose refresh state is absent or due, not frozen; earliest due first."""
    rows = lookup(movies.select("movie_id", "tmdb_id", "imdb_id", "title"), state, "movie_id",
                  [("next_refresh_due", "next_refresh_due"), ("frozen", "frozen")])
    rows = rows.where("frozen is null or not frozen").where(
        F.col("next_refresh_due").isNull() | (F.col("next_refresh_due") <= stamp(as_of)))
    if limit is None:
        return rows
    return rows.orderBy(F.asc_nulls_first("next_refresh_due"), "movie_id").limit(limit)


def recently_updated(movies: DataFrame, as_of: dt.datetime, n: int = 10) -> DataFrame:
    """The n most recently updated movies."""
    latest = F.greatest(*[F.coalesce(F.col(c), stamp(EPOCH)) for c in ("last_tmdb_update", "last_omdb_update")])
    return (
        movies.where("last_tmdb_update is not null or last_omdb_update is not null")
        .orderBy(latest.desc(), "movie_id").limit(n)
        .select("movie_id", "title", "release_date", "last_tmdb_update", "last_omdb_update", "data_frozen",
                days_since("release_date", as_of).alias("days_old"))
    )


def genre_rollup(movies: DataFrame, tmdb: DataFrame, positive_only: bool = True, limit: int | None = 10) -> DataFrame:
    """Movie count and mean revenue per genre string, most frequent first."""
    rated = tmdb.where("revenue > 0") if positive_only else tmdb
    rows = (
        movies.select("tmdb_id").join(rated.select("tmdb_id", "genres", "revenue"), "tmdb_id")
        .groupBy(F.col("genres").alias("genre_names"))
        .agg(F.count("*").alias("count"), F.avg("revenue").alias("avg_revenue"))
        .orderBy(F.desc("count"), F.asc_nulls_last("genre_names"))
    )
    return rows if limit is None else rows.limit(limit)


def missing_imdb(movies: DataFrame, tmdb: DataFrame) -> DataFrame:
    """How many movies have no IMDb id on their TMDB row, or no TMDB row."""
    known = tmdb.where("imdb_id is not null").select("tmdb_id")
    return movies.join(known, "tmdb_id", "left_anti").agg(F.count("*").alias("missing_imdb"))


def rated_since(movies: DataFrame, tmdb: DataFrame, omdb: DataFrame, after: dt.date) -> DataFrame:
    """Title, revenue and rating of movies released after a date that both sources know."""
    return (
        movies.where(F.col("release_date") > F.lit(after)).select("movie_id", "tmdb_id", "imdb_id", "title")
        .join(tmdb.select("tmdb_id", "revenue"), "tmdb_id")
        .join(omdb.select("imdb_id", "imdb_rating"), "imdb_id")
        .select("movie_id", "title", "revenue", "imdb_rating")
    )


def missing_target_topk(frame: DataFrame, n: int = 20) -> DataFrame:
    """Most voted rows without revenue, folded to one row per title.

    Per title the first non-missing value in vote order is kept, column by column.
    """
    top = frame.where("revenue is null").orderBy(F.desc_nulls_last("tmdb_vote_count"), "movie_id").limit(n)
    # Highest votes first, then lowest id: the smallest (-votes, id) that carries a value.
    place = F.struct((-F.col("tmdb_vote_count")).alias("v"), F.col("movie_id"))
    return top.groupBy("title").agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(c)
        for c in ("budget", "release_date", "tmdb_vote_count")
    ]).orderBy(F.desc_nulls_last("tmdb_vote_count"), "title")


def company_rows(frame: DataFrame, company: str, column: str = "production_company_name") -> DataFrame:
    """Rows whose company text contains ``company`` and whose money columns were not missing."""
    return frame.where(contains_text(column, company)).where("budget_missing = 0 and revenue_missing = 0")


def pending_fetch(movies: DataFrame, omdb: DataFrame, limit: int | None = 50) -> DataFrame:
    """Ids never fetched: no TMDB stamp, or an IMDb id without a title row; each list by id."""
    tmdb_ids = movies.where("last_tmdb_update is null").select(F.lit("tmdb").alias("source"), F.col("tmdb_id").cast("string").alias("id"), "movie_id")
    imdb_ids = (
        movies.where("imdb_id is not null").join(omdb.select("imdb_id"), "imdb_id", "left_anti")
        .select(F.lit("omdb").alias("source"), F.col("imdb_id").alias("id"), "movie_id")
    )
    if limit is not None:
        tmdb_ids = tmdb_ids.orderBy("movie_id").limit(limit)
        imdb_ids = imdb_ids.orderBy("movie_id").limit(limit)
    return tmdb_ids.unionByName(imdb_ids)


def mean_by_label_since(frame: DataFrame, after_year: int, label: str = "genre_names", value: str = "revenue") -> DataFrame:
    """Mean value per label string for releases after a year."""
    _, after = year_bounds(after_year, after_year)
    return frame.where(F.col("release_date") >= after).groupBy(label).agg(F.avg(value).alias(f"mean_{value}"))
