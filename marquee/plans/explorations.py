"""Queries A1-A14: counts, distributions and labels."""

from pyspark.sql import functions as F

from marquee.operators import explore, ranking
from marquee.plans.derived import flagged, modeling, star, table, with_views
from marquee.plans.registry import query
from marquee.session import materialize

NUMERIC = ["metascore", "rotten_tomatoes_rating", "meta_critic_rating", "budget", "revenue", "tmdb_vote_count",
           "tmdb_vote_average", "runtime_in_min", "tmdb_popularity", "imdb_rating", "imdb_votes"]
LABELS = ["genre_names", "production_company_name", "production_country_name", "spoken_languages", "director", "writer",
          "actors"]
TOP = {"genre_names": 3, "production_country_name": 4, "spoken_languages": 5, "actors": 20}
# The columns of the modelling view as SQL rows (feature, value).
_VALUES = {"values_v": " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM model_v WHERE {c} IS NOT NULL" for c in NUMERIC)}
# Spacing differs between the sources, so labels are split on the comma and the spaces after it.
_SPLIT = {"labels_v": " UNION ALL ".join(
    f"SELECT '{c}' AS feature, unnest(regexp_split_to_array({c}, ',\\s*')) AS label FROM model_v WHERE {c} IS NOT NULL"
    for c in LABELS)}


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


_STAR_COLUMNS = [
    "movie_id", "tmdb_id", "imdb_id", "title", "release_date", "created_at", "last_full_refresh", "last_tmdb_update",
    "last_omdb_update", "last_numbers_update", "data_frozen", "tmdb_title", "overview", "popularity", "tmdb_vote_average",
    "tmdb_vote_count", "tmdb_budget", "tmdb_revenue", "tmdb_runtime", "status", "genre_names", "production_company_name",
    "production_country_name", "spoken_languages", "rated", "released", "omdb_runtime", "omdb_genre", "director", "writer",
    "actors", "language", "country", "awards", "metascore", "imdb_rating", "imdb_votes", "box_office",
    "rotten_tomatoes_rating", "meta_critic_rating", "production_budget", "domestic_gross", "worldwide_gross"]


@query("null_counts", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM star_v" for c in _STAR_COLUMNS)))
def null_counts(spark, sf):
    return explore.null_counts(star(spark, sf))


@query("missing_overlap", with_views(
    "SELECT count(*) FILTER (budget IS NULL AND revenue IS NULL) AS both_missing, "
    "count(*) FILTER (budget IS NULL AND revenue IS NOT NULL) AS only_budget_missing, "
    "count(*) FILTER (revenue IS NULL AND budget IS NOT NULL) AS only_revenue_missing, "
    "count(*) FILTER (budget IS NULL OR revenue IS NULL) AS any_missing FROM model_v"))
def missing_overlap(spark, sf):
    return explore.missing_overlap(modeling(spark, sf, ["budget", "revenue"]), "budget", "revenue")


@query("missing_rate_by_year", with_views(
    "SELECT CAST(year(release_date) AS INT) AS release_year, round(avg(CASE WHEN budget IS NULL AND revenue IS NULL THEN 1 ELSE 0 END), 6) "
    "AS missing_rate FROM model_v WHERE release_date IS NOT NULL GROUP BY 1"))
def missing_rate_by_year(spark, sf):
    return _rounded(explore.missing_rate_by_year(modeling(spark, sf, ["release_date", "budget", "revenue"]), "budget", "revenue"), "missing_rate")


@query("label_cardinality", with_views("SELECT feature, count(DISTINCT label) AS labels FROM labels_v GROUP BY feature", **_SPLIT))
def label_cardinality(spark, sf):
    return explore.label_cardinality(modeling(spark, sf, LABELS), LABELS)


_RANKED = {
    **_SPLIT,
    "counts_v": "SELECT feature, trim(label) AS label, count(*) AS n FROM labels_v GROUP BY 1, 2",
    "ranked_v": "SELECT feature, label, n, CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, label) AS INT) AS pos FROM counts_v",
}
_WANTED = "CASE feature " + " ".join(f"WHEN '{c}' THEN {n}" for c, n in TOP.items()) + " END"


@query("top_labels", with_views(
    f"SELECT feature, label, n, pos FROM ranked_v WHERE pos <= {_WANTED} UNION ALL "
    f"SELECT feature, 'Others', CAST(coalesce(sum(n) FILTER (pos > {_WANTED}), 0) AS BIGINT), NULL FROM ranked_v "
    f"WHERE {_WANTED} IS NOT NULL GROUP BY feature", **_RANKED))
def top_labels(spark, sf):
    return explore.top_labels(modeling(spark, sf, list(TOP)), TOP)


@query("value_counts", with_views(
    "SELECT age_rating, count(*) AS n, round(count(*) / (SELECT count(age_rating) FROM model_v), 6) AS share FROM model_v "
    "WHERE age_rating IS NOT NULL GROUP BY age_rating"))
def value_counts(spark, sf):
    return _rounded(explore.value_counts(modeling(spark, sf, ["age_rating"]), "age_rating", share=True), "share")


@query("label_counts", with_views(
    "SELECT feature, label, count(*) AS n FROM labels_v WHERE feature = 'genre_names' GROUP BY 1, 2", **_SPLIT))
def label_counts(spark, sf):
    return explore.label_counts(modeling(spark, sf, ["genre_names"]), ["genre_names"], trimmed=False)


@query("counts_by_period", with_views(
    "SELECT 'year' AS period, CAST(year(release_date) AS INT) AS at, count(*) AS n FROM movies_v WHERE release_date IS NOT NULL GROUP BY 2 "
    "UNION ALL SELECT 'month', CAST(month(release_date) AS INT), count(*) FROM movies_v WHERE release_date IS NOT NULL GROUP BY 2"))
def counts_by_period(spark, sf):
    rows = modeling(spark, sf, ["release_date"])
    parts = [
        explore.counts_by_period(rows, p).select(F.lit(p).alias("period"), F.col(f"release_{p}").alias("at"), "n")
        for p in ("year", "month")
    ]
    return parts[0].unionByName(parts[1])


@query("describe_numeric", with_views(
    "SELECT feature, count(*) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min, "
    "round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS median, "
    "round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max FROM values_v GROUP BY feature", **_VALUES))
def describe_numeric(spark, sf):
    rows = _rounded(explore.describe_numeric(modeling(spark, sf, NUMERIC), NUMERIC), "q25", "median", "q75")
    return _rounded(rows, "mean", "std", digits=4)


_BINS = {
    **_VALUES,
    "bounds_v": "SELECT feature, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo, "
                "CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM values_v GROUP BY feature",
    "frame_v": "SELECT feature, lo, hi, CAST(unnest(range(30)) AS INT) AS bin FROM bounds_v",
    "binned_v": "SELECT feature, CAST(least(floor((value - lo) / (hi - lo) * 30), 29) AS INT) AS bin, count(*) AS n "
                "FROM values_v JOIN bounds_v USING (feature) GROUP BY 1, 2",
}


@query("histogram", with_views(
    "SELECT feature, bin, round(lo + (hi - lo) / 30 * bin, 4) AS left_edge, coalesce(n, 0) AS n FROM frame_v "
    "LEFT JOIN binned_v USING (feature, bin)", **_BINS))
def histogram(spark, sf):
    return _rounded(explore.histogram(modeling(spark, sf, NUMERIC), NUMERIC), "left_edge", digits=4)


_BOX = {
    **_VALUES,
    "fences_v": "SELECT feature, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM ("
                "SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
                "quantile_cont(value, 0.75) AS q3 FROM values_v GROUP BY feature)",
}


@query("box_stats", with_views(
    "SELECT feature, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, "
    "min(value) FILTER (value BETWEEN lo AND hi) AS whisker_low, max(value) FILTER (value BETWEEN lo AND hi) AS whisker_high, "
    "count(*) FILTER (value NOT BETWEEN lo AND hi) AS outliers FROM values_v JOIN fences_v USING (feature) GROUP BY 1, q1, median, q3",
    **_BOX))
def box_stats(spark, sf):
    return _rounded(explore.box_stats(modeling(spark, sf, NUMERIC), NUMERIC), "q1", "median", "q3")


@query("outliers", with_views(
    "SELECT feature, value FROM values_v JOIN fences_v USING (feature) WHERE value NOT BETWEEN lo AND hi", **_BOX))
def outliers(spark, sf):
    return explore.outliers(modeling(spark, sf, NUMERIC), NUMERIC)


@query("corr_matrix", with_views(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM model_v"
    for a in NUMERIC for b in NUMERIC)))
def corr_matrix(spark, sf):
    return _rounded(explore.corr_matrix(modeling(spark, sf, NUMERIC), NUMERIC), "corr")


@query("scatter_points", with_views(
    "SELECT budget AS x, revenue AS y FROM model_v WHERE budget IS NOT NULL AND revenue IS NOT NULL"))
def scatter_points(spark, sf):
    return explore.scatter_points(modeling(spark, sf, ["budget", "revenue"]), "budget", "revenue")


@query("scatter_bins", with_views(
    "SELECT CAST(least(floor((x - lox) / (hix - lox) * 50), 49) AS INT) AS x_bin, "
    "CAST(least(floor((y - loy) / (hiy - loy) * 50), 49) AS INT) AS y_bin, count(*) AS n FROM points_v, box_v GROUP BY 1, 2",
    points_v="SELECT CAST(budget AS DOUBLE) AS x, CAST(revenue AS DOUBLE) AS y FROM model_v WHERE budget IS NOT NULL AND revenue IS NOT NULL",
    box_v="SELECT min(x) AS lox, max(x) AS hix, min(y) AS loy, max(y) AS hiy FROM points_v"))
def scatter_bins(spark, sf):
    return explore.scatter_bins(modeling(spark, sf, ["budget", "revenue"]), "budget", "revenue")


@query("mean_by_year", with_views(
    "SELECT release_year, round(avg(budget), 2) AS mean_budget, round(avg(revenue), 2) AS mean_revenue FROM flag_v "
    "WHERE contains(lower(production_company_name), 'marvel') AND budget_missing = 0 AND revenue_missing = 0 "
    "AND release_year IS NOT NULL GROUP BY release_year"))
def mean_by_year(spark, sf):
    return _rounded(explore.mean_by_year(flagged(spark, sf), "Marvel"), "mean_budget", "mean_revenue", digits=2)


@query("part_name_labels",
       "SELECT feature, label, n, pos FROM (SELECT 'p_name' AS feature, label, count(*) AS n, "
       "CAST(row_number() OVER (ORDER BY count(*) DESC, label) AS INT) AS pos FROM "
       "(SELECT unnest(string_split(replace(p_name, ' ', ','), ',')) AS label FROM part) GROUP BY label) WHERE pos <= 5 "
       "UNION ALL SELECT 'p_name', 'Others', CAST(sum(n) AS BIGINT), NULL FROM (SELECT count(*) AS n, "
       "row_number() OVER (ORDER BY count(*) DESC, label) AS pos FROM "
       "(SELECT unnest(string_split(replace(p_name, ' ', ','), ',')) AS label FROM part) GROUP BY label) WHERE pos > 5")
def part_name_labels(spark, sf):
    names = table(spark, sf, "part").withColumn("p_name", F.replace("p_name", F.lit(" "), F.lit(",")))
    return explore.top_labels(names, {"p_name": 5})


_RANGED = ["l_quantity", "l_extendedprice", "l_discount"]


@query("range_profile", "WITH v AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') BETWEEN '1994-01' AND '1995-12' "
    f"AND {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in _RANGED)
    + ") SELECT feature, count(*) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min, "
    "max(value) AS max, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS median, "
    "round(quantile_cont(value, 0.75), 6) AS q75 FROM v GROUP BY feature")
def range_profile(spark, sf):
    """Line items by ship month: sketches stored once, then two years profiled from them with exact quantiles."""
    rows = table(spark, sf, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    sketches = materialize(ranking.period_sketches(rows, _RANGED, "month"), "sketches")
    out = ranking.range_profile(rows, _RANGED, "month", sketches, [0.25, 0.5, 0.75], "1994-01", "1995-12")
    return out.select("feature", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "max",
                      *[F.round(F.col("quantiles")[i], 6).alias(n) for i, n in enumerate(("q25", "median", "q75"))])
