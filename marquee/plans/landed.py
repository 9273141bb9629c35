"""Payload files derived from part and customer, written as JSON lines to a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.plans.derived import _cycle, _expressions, _select, _tt, table
from marquee.session import scratch_path

DISCOVER = {
    "id": "p_partkey",
    "title": "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE concat(p_name, ' ', CAST(p_partkey AS {STR})) END",
    "release_date": "CASE WHEN p_partkey % 19 = 0 THEN '' ELSE CAST(CAST({TS} '1995-01-01 00:00:00' + "
                    "(p_partkey * 37 % 2400) * INTERVAL '1' DAY AS DATE) AS {STR}) END",
    "vote_count": "CAST(p_size * 10 AS BIGINT)",
    "vote_average": "CAST(p_size AS DOUBLE) / 8",
    "popularity": "p_retailprice",
    "adult": "p_partkey % 29 = 0",
    "video": "p_partkey % 37 = 0",
}
DETAILS = {
    "id": "p_partkey",
    "imdb_id": f"CASE WHEN p_partkey % 12 = 0 THEN NULL ELSE {_tt('p_partkey')} END",
    "title": "concat(p_name, ' ', CAST(p_partkey AS {STR}))",
    "release_date": DISCOVER["release_date"],
    "status": "CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE p_type END",
    "budget": "CAST(round(p_retailprice * 1000) AS BIGINT)",
    "revenue": "CAST(round(p_retailprice * 2500) AS BIGINT)",
    "runtime": "CAST(80 + p_size AS INT)",
    "vote_count": "CAST(p_size * 10 AS BIGINT)",
    "vote_average": "CAST(p_size AS DOUBLE) / 8",
    "popularity": "p_retailprice",
    "overview": "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_name END",
}
TITLES = {
    "Response": "CASE WHEN c_custkey % 17 = 0 THEN 'False' ELSE 'True' END",
    "imdbID": _tt("c_custkey"),
    "Title": "c_name",
    "Year": "CASE c_custkey % 5 WHEN 0 THEN '2019-2021' WHEN 1 THEN 'N/A' WHEN 2 THEN NULL ELSE CAST(1990 + c_custkey % 30 AS {STR}) END",
    "Genre": _cycle("c_custkey", ["Drama", "Comedy, Drama", "N/A"]),
    "imdbRating": _cycle("c_custkey", ["7.5", "8", "N/A", ".5", "1.2.3", "5.", "1d", ".", "", "9.1", None]),
    "imdbVotes": "CASE c_custkey % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN '1,234,567' WHEN 2 THEN NULL ELSE CAST(c_custkey AS {STR}) END",
    "Metascore": _cycle("c_custkey", ["76", "N/A", "7.5", "100", " 5", None]),
    "BoxOffice": "CASE c_custkey % 7 WHEN 0 THEN 'N/A' WHEN 1 THEN '' WHEN 2 THEN '$12.5' WHEN 3 THEN ' $5 ' WHEN 4 THEN NULL "
                 "WHEN 5 THEN '1_000' ELSE concat('$1,', lpad(CAST(c_custkey % 1000 AS {STR}), 3, '0')) END",
    "Released": "concat(CAST(c_custkey % 28 + 1 AS {STR}), ' Jan 2000')",
    "Runtime": "CASE c_custkey % 6 WHEN 0 THEN '142min' WHEN 1 THEN '1,200 min' WHEN 2 THEN '  90 min' WHEN 3 THEN 'N/A' "
               "WHEN 4 THEN NULL ELSE concat(CAST(80 + c_custkey % 90 AS {STR}), ' min') END",
    "Rated": _cycle("c_custkey", ["PG-13", "R", "N/A"]),
    "Awards": "CAST(NULL AS {STR})",
}

DISCOVER_CTE = {
    "discover_v": _select({**DISCOVER, "genre_text": "concat(CAST(p_size AS {STR}), ',', CAST(p_size % 7 AS {STR}))"}, "part"),
}
DETAILS_CTE = {"details_v": _select({
    **DETAILS,
    "genres": "concat(p_type, ',', p_brand)",
    "production_companies": "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat(p_brand, ' Pictures') END",
    "production_countries": "'France'",
    "spoken_languages": "'French,English'",
}, "part")}
TITLES_CTE = {"titles_v": _select({**TITLES, "c_custkey": "c_custkey"}, "customer")}


def _land(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, f"landing-{label}")
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)
    return path


def discover_items(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.selectExpr(*_expressions(DISCOVER, "spark"),
                           "array(CAST(p_size AS BIGINT), CAST(p_size % 7 AS BIGINT)) AS genre_ids")


def land_discover(spark: SparkSession, sf: str) -> str:
    """Pages of at most twenty items."""
    items = discover_items(spark, sf)
    pages = items.groupBy(F.floor(F.col("id") / 20).alias("page")).agg(
        F.collect_list(F.struct(*items.columns)).alias("results"))
    return _land(pages.select("results", F.lit(500).alias("total_pages")), "discover")


def details_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        *_expressions(DETAILS, "spark"),
        "array(named_struct('id', 1L, 'name', p_type), named_struct('id', 2L, 'name', p_brand)) AS genres",
        "CASE WHEN p_partkey % 3 = 0 THEN array() ELSE array(named_struct('id', 7L, 'name', concat(p_brand, ' Pictures'), "
        "'origin_country', 'US')) END AS production_companies",
        "array(named_struct('iso_3166_1', 'FR', 'name', 'France')) AS production_countries",
        "array(named_struct('english_name', 'French', 'iso_639_1', 'fr', 'name', 'Français'), "
        "named_struct('english_name', 'English', 'iso_639_1', 'en', 'name', 'English')) AS spoken_languages")


def land_details(spark: SparkSession, sf: str) -> str:
    """Detail objects; every 41st line is cut short and does not parse."""
    rows = details_rows(spark, sf)
    text = F.to_json(F.struct(*rows.columns))
    path = scratch_path(spark, "landing-details")
    rows.select(F.when(F.col("id") % 41 == 0, F.substring(text, 1, 40)).otherwise(text).alias("value")).write.text(path)
    return path


def title_rows(spark: SparkSession, sf: str) -> DataFrame:
    source = "named_struct('Source', '{}', 'Value', {})"
    tomatoes, metacritic = "Rotten Tomatoes", "Metacritic"
    own = "concat(CAST(c_custkey % 101 AS STRING), '%')"
    score = "concat(CAST(c_custkey % 100 AS STRING), '/100')"
    ratings = (
        f"CASE c_custkey % 5 WHEN 0 THEN array({source.format(tomatoes, own)}, {source.format(metacritic, score)}) "
        f"WHEN 1 THEN array({source.format(tomatoes, repr('n/a'))}) WHEN 2 THEN NULL "
        f"WHEN 3 THEN array({source.format(tomatoes, repr('10%'))}, {source.format(tomatoes, own)}, {source.format(metacritic, repr('bad'))}) "
        f"ELSE array({source.format('Other', own)}, {source.format(metacritic, score)}, {source.format(metacritic, repr('x/100'))}) END AS Ratings")
    return table(spark, sf, "customer").selectExpr(*_expressions(TITLES, "spark"), ratings)


# What title_rows puts into Ratings, read back by rule.
RATINGS_SQL = {
    "rotten_tomatoes_rating": "CASE WHEN c_custkey % 5 IN (0, 3) THEN CAST(c_custkey % 101 AS INT) END",
    "meta_critic_rating": "CASE WHEN c_custkey % 5 IN (0, 4) THEN CAST(c_custkey % 100 AS INT) END",
}


def land_titles(spark: SparkSession, sf: str) -> str:
    return _land(title_rows(spark, sf), "titles")
