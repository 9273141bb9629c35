"""Queries F1-F17: features, imputation and encoders."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from marquee.functions.parse import AWARD_PATTERNS
from marquee.operators import encode, features
from marquee.operators.impute import ChainedImputer
from marquee.plans.derived import modeling, omdb, star, table, with_views
from marquee.plans.registry import query
from marquee.session import materialize

IMPUTED = ["metascore", "rotten_tomatoes_rating", "meta_critic_rating", "budget", "tmdb_vote_count", "tmdb_vote_average",
           "runtime_in_min", "tmdb_popularity", "imdb_rating", "imdb_votes"]


@query("missing_flags", with_views(
    "SELECT movie_id, " + ", ".join(f"CAST({c} IS NULL AS INT) AS {c}_missing" for c in features.FLAGGED_COLUMNS) + " FROM model_v"))
def missing_flags(spark, sf):
    rows = features.missing_flags(modeling(spark, sf), features.FLAGGED_COLUMNS)
    return rows.select("movie_id", *[f"{c}_missing" for c in features.FLAGGED_COLUMNS])


_NUMBER_TEXT = ("CASE c_custkey % 8 WHEN 0 THEN '1,234' WHEN 1 THEN '1e3' WHEN 2 THEN ' 7 ' WHEN 3 THEN '-2.5' WHEN 4 THEN '1d' "
                "WHEN 5 THEN 'nan' WHEN 6 THEN NULL ELSE concat(CAST(c_custkey AS {}), '.5') END")


@query("to_numeric",
       "SELECT c_custkey, CASE WHEN regexp_full_match(trim(t), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
       f"THEN TRY_CAST(trim(t) AS DOUBLE) END AS votes FROM (SELECT c_custkey, replace({_NUMBER_TEXT.format('VARCHAR')}, ',', '') AS t FROM customer)")
def to_numeric(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.expr(_NUMBER_TEXT.format("STRING")).alias("votes"))
    return features.to_numeric(rows, ["votes"])


def _award_sql(name: str) -> str:
    # DuckDB has no lookahead: wins before the last mention of the Oscars are cut away instead.
    text = "regexp_replace(awards, '^.*Oscars', '', 'i')" if name == "total_wins" else "awards"
    pattern = AWARD_PATTERNS[name].replace("(?!.*Oscars)", "").replace("'", "''")
    return f"coalesce(TRY_CAST(regexp_extract({text}, '(?i){pattern}', 1) AS INT), 0) AS {name}"


@query("awards", with_views("SELECT imdb_id, " + ", ".join(_award_sql(n) for n in AWARD_PATTERNS) + " FROM omdb_v"))
def awards(spark, sf):
    return features.award_features(omdb(spark, sf).select("imdb_id", "awards"))


@query("date_features", with_views(
    "SELECT movie_id, release_date, CAST(year(release_date) AS INT) AS release_year, CAST(month(release_date) AS INT) AS release_month, "
    "CAST(day(release_date) AS INT) AS release_day, CAST(coalesce(isodow(release_date) >= 5, FALSE) AS INT) AS is_weekend, "
    "CAST(coalesce(month(release_date) IN (6, 7, 11, 12), FALSE) AS INT) AS is_holiday_season, "
    "CAST(2025 - year(release_date) AS INT) AS movie_age FROM model_v"))
def date_features(spark, sf):
    return features.date_features(modeling(spark, sf, ["movie_id", "release_date"]))


@query("roi", with_views(
    "SELECT movie_id, round(CAST(revenue - budget AS DOUBLE) / nullif(budget, 0), 8) AS roi FROM model_v"))
def roi(spark, sf):
    return features.roi(modeling(spark, sf)).select("movie_id", F.round("roi", 8).alias("roi"))


@query("billing", with_views(
    "SELECT movie_id, " + ", ".join(
        f"trim(string_split({source}, ',')[{i + 1}]) AS {name}"
        for source, names in features.BILLING.items() for i, name in enumerate(names)) + " FROM star_v"))
def billing(spark, sf):
    return features.billing(star(spark, sf).select("movie_id", "actors", "director", "writer"))


_GROUPED = {
    "labels_v": "SELECT trim(unnest(regexp_split_to_array(production_country_name, ',\\s*'))) AS label FROM model_v",
    "top_v": "SELECT label FROM labels_v GROUP BY label ORDER BY count(*) DESC, label LIMIT 3",
    "mapped_v": "SELECT movie_id, pos, CASE WHEN label IN (SELECT label FROM top_v) THEN label ELSE 'Others' END AS label FROM ("
                "SELECT movie_id, unnest(range(len(parts))) AS pos, trim(unnest(parts)) AS label FROM ("
                "SELECT movie_id, string_split(production_country_name, ',') AS parts FROM model_v WHERE production_country_name IS NOT NULL))",
    "first_v": "SELECT movie_id, label, min(pos) AS pos FROM mapped_v GROUP BY 1, 2",
}


@query("group_rare_labels", with_views(
    "SELECT movie_id, string_agg(label, ',' ORDER BY pos) AS production_country_name FROM first_v GROUP BY movie_id UNION ALL "
    "SELECT movie_id, NULL FROM model_v WHERE production_country_name IS NULL", **_GROUPED))
def group_rare_labels(spark, sf):
    rows = modeling(spark, sf, ["movie_id", "production_country_name"])
    return features.RareLabelGrouper({"production_country_name": 3}).fit(rows).transform(rows)


@query("drop_columns", with_views(
    "SELECT * EXCLUDE (production_company_name, director, writer, actors, title, release_date) FROM model_v"))
def drop_columns(spark, sf):
    return features.drop_columns(modeling(spark, sf), [*features.DROPPED_COLUMNS, "no_such_column"])


@query("impute_constant", with_views(
    "SELECT movie_id, " + ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in features.UNKNOWN_COLUMNS) + ", "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in features.ZERO_COLUMNS) + " FROM model_v"))
def impute_constant(spark, sf):
    rows = modeling(spark, sf, ["movie_id", *features.UNKNOWN_COLUMNS, *features.ZERO_COLUMNS])
    return features.impute_constant(rows)


@query("impute_median", with_views(
    "SELECT movie_id, coalesce(CAST(runtime_in_min AS DOUBLE), (SELECT quantile_cont(CAST(runtime_in_min AS DOUBLE), 0.5) FROM model_v)) "
    "AS runtime_in_min FROM model_v"))
def impute_median(spark, sf):
    rows = modeling(spark, sf, ["movie_id", "runtime_in_min"])
    return features.MedianImputer(["runtime_in_min"]).fit(rows).transform(rows)


# No SQL: an iterative fit. Tests hold it against planted linear data.
@query("impute_chained")
def impute_chained(spark, sf):
    rows = modeling(spark, sf, ["movie_id", *IMPUTED])
    return ChainedImputer(IMPUTED).fit(rows).transform(rows)


@query("column_select", with_views(
    "SELECT 'number' AS kind, 'movie_id' AS name, count(movie_id) AS present FROM model_v UNION ALL SELECT 'number', 'imdb_rating', count(imdb_rating) FROM model_v "
    "UNION ALL SELECT 'text', 'title', count(title) FROM model_v UNION ALL SELECT 'text', 'director', count(director) FROM model_v"))
def column_select(spark, sf):
    rows = modeling(spark, sf, ["movie_id", "title", "release_date", "imdb_rating", "director", "data_frozen"])
    kinds = [(k, n) for k in ("number", "text") for n in features.column_select(rows, k)]
    counted = rows.agg(*[F.count(n).alias(n) for _, n in kinds])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(n).alias("name"), F.col(n).alias("present")) for k, n in kinds])))


def _steps() -> Pipeline:
    """The preparation chain as stages of one pipeline."""
    return Pipeline(stages=[
        features.FrameStep(lambda df: features.to_numeric(df, features.ZERO_COLUMNS)),
        features.FrameStep(features.impute_constant),
        features.MedianImputer(["runtime_in_min"]),
        features.FrameStep(features.award_features),
        features.RareLabelGrouper({"production_country_name": 5, "spoken_languages": 5}),
        features.FrameStep(lambda df: features.missing_flags(df, features.FLAGGED_COLUMNS)),
        features.FrameStep(features.roi),
        features.FrameStep(features.date_features),
        features.FrameStep(features.drop_columns),
    ])


# No SQL: a chain of fitted steps, each of which has its own query.
@query("column_steps")
def column_steps(spark, sf):
    rows = modeling(spark, sf)
    return _steps().fit(rows).transform(rows)


_GENRES = ["Action", "Comedy", "Documentary", "Drama", "Science_Fiction"]


@query("multilabel_columns", with_views(
    "SELECT movie_id, " + ", ".join(
        f"CAST(coalesce(list_contains(items, '{g}'), FALSE) AS INT) AS genre_names_{g}" for g in _GENRES)
    + " FROM (SELECT movie_id, string_split(replace(regexp_replace(genre_names, '\\s*,\\s*', ',', 'g'), ' ', '_'), ',') AS items FROM model_v)"))
def multilabel_columns(spark, sf):
    rows = modeling(spark, sf, ["movie_id", "genre_names"])
    return encode.multilabel_columns(rows, "genre_names", _GENRES)


def _label_views(c: str) -> dict[str, str]:
    """Dictionary, and codes of every distinct cell, of one label column."""
    items = f"string_split(replace(regexp_replace({c}, '\\s*,\\s*', ',', 'g'), ' ', '_'), ',')"
    return {
        f"{c}_items_v": f"SELECT DISTINCT {c} AS cell, unnest({items}) AS label FROM model_v WHERE {c} IS NOT NULL",
        f"{c}_code_v": f"SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT label FROM {c}_items_v)",
        f"{c}_cell_v": f"SELECT cell, string_agg(CAST(code AS VARCHAR), ',' ORDER BY code) AS codes FROM {c}_items_v JOIN {c}_code_v USING (label) GROUP BY cell",
    }


@query("multilabel_binarize", with_views(
    "SELECT movie_id, " + ", ".join(f"coalesce({c}_cell_v.codes, '') AS {c}_codes" for c in encode.MULTI_LABEL) + " FROM model_v "
    + " ".join(f"LEFT JOIN {c}_cell_v ON {c}_cell_v.cell = model_v.{c}" for c in encode.MULTI_LABEL),
    **{k: v for c in encode.MULTI_LABEL for k, v in _label_views(c).items()}))
def multilabel_binarize(spark, sf):
    """All three label columns as arrays of codes, shown as text."""
    rows = modeling(spark, sf, ["movie_id", *encode.MULTI_LABEL])
    for c in encode.MULTI_LABEL:
        rows = encode.MultiLabelBinarizer(c).fit(rows).transform(rows)
    return rows.select("movie_id", *[F.array_join(F.col(f"{c}_codes").cast("array<string>"), ",").alias(f"{c}_codes") for c in encode.MULTI_LABEL])


_SCALED = ["metascore", "tmdb_vote_count", "tmdb_vote_average", "tmdb_popularity", "imdb_rating", "imdb_votes"]


@query("standard_scale", with_views(
    "SELECT movie_id, " + ", ".join(
        f"round((CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM model_v)) / (SELECT stddev_pop({c}) FROM model_v), 6) AS {c}" for c in _SCALED)
    + " FROM model_v"))
def standard_scale(spark, sf):
    rows = modeling(spark, sf, ["movie_id", *_SCALED])
    out = encode.StandardScaler(_SCALED).fit(rows).transform(rows)
    return out.withColumns({c: F.round(c, 6) for c in _SCALED})


@query("one_hot_columns", with_views(
    "SELECT movie_id, " + ", ".join(f"CAST(coalesce(age_rating = '{v}', FALSE) AS INT) AS \"age_rating_{v}\"" for v in ("G", "PG", "PG-13", "R"))
    + ", CAST(age_rating IS NULL AS INT) AS \"age_rating_None\" FROM model_v"))
def one_hot_columns(spark, sf):
    rows = modeling(spark, sf, ["movie_id", "age_rating"])
    return encode.one_hot_columns(rows, "age_rating", ["G", "PG", "PG-13", "R"])


@query("one_hot", with_views(
    "SELECT movie_id, CASE WHEN m.age_rating IS NULL THEN (SELECT count(*) FROM rating_v) ELSE r.code END AS age_rating_code "
    "FROM model_v m LEFT JOIN rating_v r ON m.age_rating = r.age_rating",
    rating_v="SELECT age_rating, row_number() OVER (ORDER BY age_rating) - 1 AS code FROM (SELECT DISTINCT age_rating FROM model_v WHERE age_rating IS NOT NULL)"))
def one_hot(spark, sf):
    rows = modeling(spark, sf, ["movie_id", "age_rating"])
    return encode.OneHotEncoder("age_rating").fit(rows).transform(rows)


_ORDINAL = {
    "train_v": "SELECT * FROM model_v WHERE release_date < DATE '1999-01-01'",
    "director_v": "SELECT director, row_number() OVER (ORDER BY director) - 1 AS code FROM (SELECT DISTINCT director FROM train_v WHERE director IS NOT NULL)",
    "writer_v": "SELECT writer, row_number() OVER (ORDER BY writer) - 1 AS code FROM (SELECT DISTINCT writer FROM train_v WHERE writer IS NOT NULL)",
}


@query("ordinal_encode", with_views(
    "SELECT movie_id, CAST(CASE WHEN m.director IS NOT NULL THEN coalesce(d.code, 999999) END AS DOUBLE) AS director, "
    "CAST(CASE WHEN m.writer IS NOT NULL THEN coalesce(w.code, 999999) END AS DOUBLE) AS writer FROM model_v m "
    "LEFT JOIN director_v d ON m.director = d.director LEFT JOIN writer_v w ON m.writer = w.writer", **_ORDINAL))
def ordinal_encode(spark, sf):
    """Fitted on the releases before 1999, applied to all."""
    rows = materialize(modeling(spark, sf, ["movie_id", "release_date", "director", "writer"]), "ordinal-rows")  # fitted twice, then encoded
    train = rows.where("release_date < DATE '1999-01-01'")
    return encode.OrdinalEncoder(["director", "writer"]).fit(train).transform(rows).drop("release_date")
