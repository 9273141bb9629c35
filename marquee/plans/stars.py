"""Queries J1-J15: star joins, filters and top-k."""

import datetime as dt

from pyspark.sql import functions as F

from marquee.operators import joins
from marquee.operators.joins import FINANCIAL_OMDB, FINANCIAL_TMDB
from marquee.plans.derived import AS_OF, flagged, modeling, movies, numbers, omdb, refresh_state, star, tmdb, with_views
from marquee.plans.registry import query


@query("full_dataset", with_views("SELECT * FROM fanout_v"))
def full_dataset(spark, sf):
    return star(spark, sf, one_row_per_movie=False)


@query("full_dataset_not_null",
       with_views("SELECT * FROM fanout_v WHERE tmdb_budget IS NOT NULL AND tmdb_revenue IS NOT NULL"))
def full_dataset_not_null(spark, sf):
    return joins.full_dataset(movies(spark, sf), tmdb(spark, sf), omdb(spark, sf), numbers(spark, sf), include_nulls=False)


@query("full_dataset_latest", with_views("SELECT * FROM star_v"))
def full_dataset_latest(spark, sf):
    return star(spark, sf)


@query("modeling_view", with_views("SELECT * FROM model_v"))
def modeling_view(spark, sf):
    return modeling(spark, sf)


@query("resolve_imdb_id", with_views(
    "SELECT m.movie_id, m.tmdb_id, coalesce(m.imdb_id, nullif(t.imdb_id, '')) AS imdb_id "
    "FROM movies_v m LEFT JOIN tmdb_v t ON m.tmdb_id = t.tmdb_id"))
def resolve_imdb_id(spark, sf):
    return joins.resolve_imdb_id(movies(spark, sf).select("movie_id", "tmdb_id", "imdb_id"), tmdb(spark, sf))


@query("imdb_ids_for", with_views(
    "SELECT DISTINCT t.imdb_id FROM tmdb_v t WHERE t.tmdb_id IN (SELECT tmdb_id FROM movies_v WHERE NOT data_frozen) "
    "AND t.imdb_id IS NOT NULL AND t.imdb_id <> ''"))
def imdb_ids_for(spark, sf):
    return joins.imdb_ids_for(movies(spark, sf).where("not data_frozen"), tmdb(spark, sf))


_FINANCIAL = ", ".join([f"t.{c} AS {o}" for c, o in FINANCIAL_TMDB] + [f"o.{c} AS {o}" for c, o in FINANCIAL_OMDB])


@query("financials", with_views(
    f"SELECT m.*, {_FINANCIAL} FROM movies_v m JOIN tmdb_v t ON m.tmdb_id = t.tmdb_id "
    "LEFT JOIN omdb_v o ON m.imdb_id = o.imdb_id WHERE t.budget >= 100000 AND t.revenue >= 200000 "
    "AND t.budget IS NOT NULL AND t.revenue IS NOT NULL ORDER BY m.release_date DESC"))
def financials(spark, sf):
    return joins.financials(movies(spark, sf), tmdb(spark, sf), omdb(spark, sf), 100_000, 200_000)


@query("query_movies", with_views(
    "SELECT movie_id, title, release_date FROM movies_v WHERE data_frozen = TRUE AND last_omdb_update IS NULL "
    "ORDER BY release_date DESC NULLS LAST, movie_id LIMIT 100"))
def query_movies(spark, sf):
    return joins.query_movies(
        movies(spark, sf), {"data_frozen": True, "last_omdb_update": None}, ["movie_id", "title", "release_date"],
        limit=100, order_by=[("release_date", True), ("movie_id", False)])


@query("year_range", with_views("SELECT * FROM movies_v WHERE year(release_date) BETWEEN 1997 AND 1999"))
def year_range(spark, sf):
    return joins.by_year_range(movies(spark, sf), 1997, 1999)


@query("refresh_state_due", with_views(
    "SELECT m.movie_id, m.tmdb_id, m.imdb_id, m.title, s.next_refresh_due, s.frozen FROM movies_v m "
    "LEFT JOIN state_v s USING (movie_id) WHERE (s.frozen IS NULL OR s.frozen = FALSE) "
    "AND (s.next_refresh_due IS NULL OR s.next_refresh_due <= TIMESTAMP '2001-08-02 12:00:00') "
    "ORDER BY s.next_refresh_due NULLS FIRST, m.movie_id LIMIT 1000"))
def refresh_state_due(spark, sf):
    return joins.refresh_state_due(movies(spark, sf), refresh_state(spark, sf), AS_OF)


@query("recently_updated", with_views(
    "SELECT movie_id, title, release_date, last_tmdb_update, last_omdb_update, data_frozen, "
    "CAST(datediff('day', release_date, DATE '2001-08-02') AS INT) AS days_old FROM movies_v "
    "WHERE last_tmdb_update IS NOT NULL OR last_omdb_update IS NOT NULL "
    "ORDER BY greatest(coalesce(last_tmdb_update, TIMESTAMP '1970-01-01'), coalesce(last_omdb_update, TIMESTAMP '1970-01-01')) DESC, "
    "movie_id LIMIT 10"))
def recently_updated(spark, sf):
    return joins.recently_updated(movies(spark, sf), AS_OF)


_ROLLUP = ("SELECT t.genres AS genre_names, count(*) AS count, round(avg(t.revenue), 2) AS avg_revenue FROM movies_v m "
           "JOIN tmdb_v t ON m.tmdb_id = t.tmdb_id {where} GROUP BY t.genres")


@query("genre_rollup", with_views(
    _ROLLUP.format(where="WHERE t.revenue > 0") + " ORDER BY count DESC, genre_names NULLS LAST LIMIT 5"))
def genre_rollup(spark, sf):
    return joins.genre_rollup(movies(spark, sf), tmdb(spark, sf), limit=5).withColumn("avg_revenue", F.round("avg_revenue", 2))


@query("genre_rollup_all", with_views(_ROLLUP.format(where="")))
def genre_rollup_all(spark, sf):
    rows = joins.genre_rollup(movies(spark, sf), tmdb(spark, sf), positive_only=False, limit=None)
    return rows.withColumn("avg_revenue", F.round("avg_revenue", 2))


@query("missing_imdb", with_views(
    "SELECT count(*) AS missing_imdb FROM movies_v m LEFT JOIN tmdb_v t ON m.tmdb_id = t.tmdb_id WHERE t.imdb_id IS NULL"))
def missing_imdb(spark, sf):
    return joins.missing_imdb(movies(spark, sf), tmdb(spark, sf))


@query("rated_since", with_views(
    "SELECT m.movie_id, m.title, t.revenue, o.imdb_rating FROM movies_v m JOIN tmdb_v t ON m.tmdb_id = t.tmdb_id "
    "JOIN omdb_v o ON m.imdb_id = o.imdb_id WHERE m.release_date > DATE '2000-01-01'"))
def rated_since(spark, sf):
    return joins.rated_since(movies(spark, sf), tmdb(spark, sf), omdb(spark, sf), dt.date(2000, 1, 1))


@query("missing_target_topk", with_views(
    "SELECT title, first(budget ORDER BY tmdb_vote_count DESC, movie_id) FILTER (budget IS NOT NULL) AS budget, "
    "first(release_date ORDER BY tmdb_vote_count DESC, movie_id) FILTER (release_date IS NOT NULL) AS release_date, "
    "first(tmdb_vote_count ORDER BY tmdb_vote_count DESC, movie_id) FILTER (tmdb_vote_count IS NOT NULL) AS tmdb_vote_count "
    "FROM (SELECT concat('Title ', CAST(movie_id % 7 AS VARCHAR)) AS title, budget, release_date, tmdb_vote_count, movie_id "
    "FROM model_v WHERE revenue IS NULL ORDER BY tmdb_vote_count DESC NULLS LAST, movie_id LIMIT 20) GROUP BY title"))
def missing_target_topk(spark, sf):
    # Titles are folded so that some of the top rows share one.
    frame = modeling(spark, sf).withColumn("title", F.concat(F.lit("Title "), (F.col("movie_id") % 7).cast("string")))
    return joins.missing_target_topk(frame)


@query("contains_filter", with_views(
    "SELECT movie_id, release_year, budget, revenue FROM flag_v WHERE coalesce(contains(lower(production_company_name), 'marvel'), FALSE) "
    "AND budget_missing = 0 AND revenue_missing = 0"))
def contains_filter(spark, sf):
    return joins.company_rows(flagged(spark, sf), "Marvel").select("movie_id", "release_year", "budget", "revenue")


@query("pending_fetch", with_views(
    "SELECT * FROM (SELECT 'tmdb' AS source, CAST(tmdb_id AS VARCHAR) AS id, movie_id FROM movies_v WHERE last_tmdb_update IS NULL "
    "ORDER BY movie_id LIMIT 50) UNION ALL SELECT * FROM (SELECT 'omdb' AS source, m.imdb_id AS id, m.movie_id FROM movies_v m "
    "LEFT JOIN (SELECT * FROM omdb_v WHERE year <> 2000) o ON m.imdb_id = o.imdb_id "
    "WHERE m.imdb_id IS NOT NULL AND o.imdb_id IS NULL ORDER BY m.movie_id LIMIT 50)"))
def pending_fetch(spark, sf):
    return joins.pending_fetch(movies(spark, sf), omdb(spark, sf).where("year <> 2000"))


@query("mean_by_label_since", with_views(
    "SELECT genre_names, round(avg(revenue), 2) AS mean_revenue FROM model_v WHERE year(release_date) > 1998 GROUP BY genre_names"))
def mean_by_label_since(spark, sf):
    rows = joins.mean_by_label_since(modeling(spark, sf), 1998)
    return rows.withColumn("mean_revenue", F.round("mean_revenue", 2))
