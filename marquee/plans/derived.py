"""Movie tables derived from the test tables, as one expression list per table for both engines.

The reference data model has no data files, so its tables are computed from orders, lineitem, customer
and supplier. NULLs, empty texts, repeated rows and parse problems are put in by key arithmetic. Each
list serves Spark (``selectExpr``) and the DuckDB oracle (a CTE).
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators.features import missing_flags
from marquee.operators.joins import STAR_NUMBERS, STAR_OMDB, STAR_TMDB, full_dataset, modeling_view, star_columns
from marquee.session import materialize

AS_OF = dt.datetime(2001, 8, 2, 12, 0, 0)
_DIALECT = {
    "spark": {"STR": "STRING", "TS": "TIMESTAMP_NTZ"},
    "duckdb": {"STR": "VARCHAR", "TS": "TIMESTAMP"},
}
_DAY0 = "{TS} '2001-08-02 00:00:00'"


def _ago(key: str, days: int) -> str:
    return f"{_DAY0} - ({key} % {days}) * INTERVAL '1' DAY"


def _tt(key: str) -> str:
    return f"concat('tt', lpad(CAST({key} AS {{STR}}), 7, '0'))"


def _cycle(key: str, values: list[str | None]) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {cases} END"


MOVIES = {
    "movie_id": "CAST(o_orderkey AS BIGINT)",
    "tmdb_id": "CAST(o_orderkey AS BIGINT)",
    "imdb_id": f"CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {_tt('o_custkey')} END",
    "title": "concat('Movie ', CAST(o_orderkey AS {STR}))",
    "release_date": "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END",
    "created_at": "CAST(o_orderdate AS {TS})",
    "last_full_refresh": f"CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {_ago('o_orderkey', 90)} END",
    "last_tmdb_update": f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_ago('o_orderkey', 120)} END",
    "last_omdb_update": f"CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_ago('o_orderkey', 240)} END",
    "last_numbers_update": f"CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {_ago('o_orderkey', 200)} END",
    "data_frozen": "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderstatus = 'F' END",
}

_TMDB_SUMS = {
    "price": "sum(l_extendedprice)",
    "gross": "sum(l_extendedprice * (1 + l_tax) * (1.5 - 10 * l_discount + l_quantity / 50))",
    "quantity": "sum(l_quantity)",
    "longest": "max(l_quantity)",
    "items": "count(*)",
    "supp": "min(l_suppkey)",
    "status": "max(l_linestatus)",
}
TMDB = {
    "tmdb_id": "l_orderkey",
    "imdb_id": f"CASE WHEN l_orderkey % 13 = 0 THEN '' WHEN l_orderkey % 17 = 0 THEN NULL ELSE {_tt('supp')} END",
    "title": "concat('Film ', CAST(l_orderkey AS {STR}))",
    "release_date": "CAST({TS} '1995-01-01 00:00:00' + (l_orderkey % 2400) * INTERVAL '1' DAY AS DATE)",
    "status": "CASE status WHEN 'O' THEN 'Released' ELSE 'Post Production' END",
    "budget": "CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 53 = 0 THEN 0 ELSE CAST(round(price) AS BIGINT) END",
    "revenue": "CASE WHEN l_orderkey % 9 = 0 OR l_orderkey % 14 = 0 THEN NULL ELSE CAST(round(gross) AS BIGINT) END",
    "runtime": "CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(longest * 3 AS INT) END",
    "vote_count": "CAST(items * 60 + l_orderkey % 100 AS INT)",
    "vote_average": "round(quantity / items / 5, 4)",
    "popularity": "quantity / 10",
    "genres": _cycle("l_orderkey", [
        "Drama", "Drama,Comedy", "Action,Science Fiction", None, "Comedy", "Action, Drama", "Documentary"]),
    "production_companies": _cycle("l_orderkey", [
        "Marvel Studios,Walt Disney Pictures", "Warner Bros. Pictures", None, "marvel entertainment", "Toho"]),
    "production_countries": _cycle("l_orderkey", [
        "United States of America", "United States of America,France", "France, Germany", "Japan", None,
        "United Kingdom,United States of America", "Canada", "India", "Spain,Italy", "Germany"]),
    "spoken_languages": _cycle("l_orderkey", [
        "English", "English,French", "German, English", "Japanese", None, "Hindi", "Spanish,Italian,English", "Korean"]),
    "overview": "concat('Overview of film ', CAST(l_orderkey AS {STR}))",
    "last_updated_utc": _ago("l_orderkey", 50),
}

_AWARDS = (
    "CASE c_custkey % 6 WHEN 0 THEN 'N/A' "
    "WHEN 1 THEN concat('Won ', CAST(c_custkey % 9 + 1 AS {STR}), ' Oscars. ', CAST(c_custkey % 60 AS {STR}), "
    "' wins & ', CAST(c_custkey % 90 AS {STR}), ' nominations total') "
    "WHEN 2 THEN concat('Nominated for ', CAST(c_custkey % 4 + 1 AS {STR}), ' Oscars. ', CAST(c_custkey % 60 AS {STR}), "
    "' wins & ', CAST(c_custkey % 90 AS {STR}), ' nominations total') "
    "WHEN 3 THEN concat('Nominated for ', CAST(c_custkey % 3 + 1 AS {STR}), ' BAFTA Award', "
    "CAST(c_custkey % 30 AS {STR}), ' nominations total') "
    "WHEN 4 THEN concat('Won 1 BAFTA Award', CAST(c_custkey % 12 AS {STR}), ' wins & 9 nominations total') "
    "ELSE '1 win & 1 nomination' END"
)
OMDB = {
    "imdb_id": _tt("c_custkey"),
    "title": "concat('Title ', CAST(c_custkey AS {STR}))",
    "year": "CAST(1990 + c_custkey % 30 AS INT)",
    "genre": _cycle("c_custkey", ["Drama", "Comedy, Drama", "Action"]),
    "director": "CASE WHEN c_custkey % 8 = 0 THEN concat(c_name, ' ,Second ', CAST(c_nationkey AS {STR})) "
                "WHEN c_custkey % 41 = 0 THEN NULL ELSE c_name END",
    "writer": "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('Writer ', CAST(c_custkey % 90 AS {STR}), ', ', c_name) END",
    "actors": "concat(c_mktsegment, ', ', c_name, ', Actor ', CAST(c_custkey % 50 AS {STR}))",
    "imdb_rating": "CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE CAST(c_custkey % 100 AS DOUBLE) / 10 END",
    "imdb_votes": "CASE WHEN c_custkey % 22 = 0 THEN NULL ELSE CAST(c_custkey * 37 % 100000 AS INT) END",
    "metascore": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey * 7 % 101 AS INT) END",
    "box_office": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(round(c_acctbal) AS BIGINT) END",
    "released": "concat(CAST(c_custkey % 28 + 1 AS {STR}), ' Jan ', CAST(1990 + c_custkey % 30 AS {STR}))",
    "runtime": "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(80 + c_custkey % 90 AS INT) END",
    "language": _cycle("c_custkey", ["English", "French, English", None]),
    "country": _cycle("c_nationkey", ["USA", "UK, USA", "France", "Japan"]),
    "rated": _cycle("c_custkey", ["PG-13", "R", "PG", None, "R", "G", "R"]),
    "awards": _AWARDS,
    "rotten_tomatoes_rating": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey * 3 % 101 AS INT) END",
    "meta_critic_rating": "CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE CAST(c_custkey * 5 % 101 AS INT) END",
    "last_updated_utc": _ago("c_custkey", 80),
}
# Two rows for most ids: joining them as they are fans out.
NUMBERS = {
    "movie_id": "CAST(floor(s_suppkey / 1.5) AS BIGINT)",
    "domestic_box_office": "CAST(round(s_acctbal * 100) AS BIGINT)",
    "international_box_office": "CAST(round(s_acctbal * 60) AS BIGINT)",
    "worldwide_box_office": "CAST(round(s_acctbal * 100) AS BIGINT) + CAST(round(s_acctbal * 60) AS BIGINT)",
    "release_year": "CAST(1995 + s_suppkey % 7 AS INT)",
    "production_budget": "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(round(s_acctbal * 40) AS BIGINT) END",
    "opening_weekend_box_office": "CAST(round(s_acctbal * 10) AS BIGINT)",
    "last_updated_utc": _ago("s_suppkey", 45),
}
STATE = {
    "movie_id": "CAST(o_orderkey AS BIGINT)",
    "refresh_interval_days": "CAST(30 AS INT)",
    "next_refresh_due": "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE "
                        f"{_DAY0} + (o_orderkey % 61 - 30) * INTERVAL '1' DAY END",
    "freeze_after_days": "CAST(365 AS INT)",
    "frozen": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 10 = 0 END",
    "last_checked": _ago("o_orderkey", 33),
}
STATE_FILTER = "o_orderkey % 4 <> 1"


def _expressions(columns: dict[str, str], engine: str) -> list[str]:
    return [f"{e.format(**_DIALECT[engine])} AS {n}" for n, e in columns.items()]


def _select(columns: dict[str, str], source: str, where: str = "") -> str:
    return f"SELECT {', '.join(_expressions(columns, 'duckdb'))} FROM {source}{where}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# In Spark a greatest text makes an aggregate sort its input; two flags say the same of the only value that is asked for.
_SPARK_SUMS = {**_TMDB_SUMS, "status": "CASE WHEN bool_or(l_linestatus = 'O') AND NOT bool_or(l_linestatus > 'O') THEN 'O' END"}
_SOURCES = {"movies": ("orders", MOVIES), "tmdb": ("lineitem", TMDB), "omdb": ("customer", OMDB), "numbers": ("supplier", NUMBERS),
            "refresh_state": ("orders", STATE)}
#: Source rows that one sorted partition of a stored table takes.
ROWS_PER_PART = 500_000


def _sources(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, dict[str, str], int]:
    """(rows a derived table is made of, its columns as expressions on them, number of source rows)."""
    source, columns = _SOURCES[name]
    rows = table(spark, sf_dir, source)
    n = rows.count()
    if name == "tmdb":
        rows = rows.groupBy("l_orderkey").agg(*[F.expr(e).alias(n) for n, e in _SPARK_SUMS.items()])
    if name == "refresh_state":
        rows = rows.where(STATE_FILTER)
    return rows, columns, n


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived table, written on first use in a session and read from then on.

    The movie tables are stored tables in the data model; recomputing them inside every query would
    hide what the queries themselves cost, and keep filters from reaching a scan.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        # Movies lie in date order, so date filters skip files; the others are spread by key.
        # The id splits dates, and rows without one, that are frequent.
        cluster = {"movies": ["release_date", "movie_id"], "tmdb": ["tmdb_id"], "omdb": ["imdb_id"]}.get(name, ["movie_id"])
        rows, columns, n = _sources(spark, sf_dir, name)
        # Only the few source columns are shuffled and sorted, in parts of bounded size; the texts are made when a part is written.
        order = [F.expr(columns[c].format(**_DIALECT["spark"])) for c in cluster]
        parts = max(spark.sparkContext.defaultParallelism, math.ceil(n / ROWS_PER_PART))
        used = [c for c in rows.columns if any(re.search(rf"\b{c}\b", e) for e in columns.values())]
        # The line items were dealt out by their sums' key; dealing the sums again would shuffle all of them twice.
        placed = rows.select(*used) if name == "tmdb" else rows.select(*used).repartitionByRange(parts, *order)
        _STORED[key] = materialize(placed.sortWithinPartitions(*order).selectExpr(*_expressions(columns, "spark")), f"derived-{name}", "zstd")
    return _STORED[key]


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "movies")


def tmdb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "tmdb")


def omdb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "omdb")


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "numbers")


def refresh_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "refresh_state")


def star(spark: SparkSession, sf_dir: str, one_row_per_movie: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    parts = [f(spark, sf_dir) for f in (movies, tmdb, omdb, numbers)]
    return full_dataset(*parts, one_row_per_movie=one_row_per_movie, columns=columns)


def modeling(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The modelling view, or the given columns of it with only the sources they need."""
    if columns is None:
        return modeling_view(star(spark, sf_dir))
    return modeling_view(star(spark, sf_dir, columns=star_columns(columns))).select(*columns)


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling view with missing flags and the release year."""
    return missing_flags(modeling(spark, sf_dir), ["budget", "revenue"]).withColumn("release_year", F.year("release_date"))


def _star_sql() -> str:
    columns = ["m.*"]
    for alias, listed in (("t", STAR_TMDB), ("o", STAR_OMDB), ("n", STAR_NUMBERS)):
        columns += [f"{alias}.{c} AS {out}" for c, out in listed]
    return (
        f"SELECT {', '.join(columns)} FROM movies_v m LEFT JOIN tmdb_v t ON m.tmdb_id = t.tmdb_id "
        "LEFT JOIN omdb_v o ON m.imdb_id = o.imdb_id LEFT JOIN {numbers} n ON m.movie_id = n.movie_id"
    )


def _sums_sql() -> str:
    return f"SELECT l_orderkey, {', '.join(f'{e} AS {n}' for n, e in _TMDB_SUMS.items())} FROM lineitem GROUP BY l_orderkey"


# Names that queries in DuckDB may use after WITH.
CTES = {
    "movies_v": _select(MOVIES, "orders"),
    "tmdb_v": _select(TMDB, f"({_sums_sql()})"),
    "omdb_v": _select(OMDB, "customer"),
    "numbers_v": _select(NUMBERS, "supplier"),
    "numbers_latest_v": "SELECT * FROM numbers_v QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY "
                        "last_updated_utc DESC, domestic_box_office DESC, international_box_office DESC) = 1",
    "state_v": _select(STATE, "orders", f" WHERE {STATE_FILTER}"),
    "fanout_v": _star_sql().format(numbers="numbers_v"),
    "star_v": _star_sql().format(numbers="numbers_latest_v"),
    "model_v": "SELECT * EXCLUDE (tmdb_runtime, omdb_runtime) RENAME (tmdb_budget AS budget, tmdb_revenue AS revenue, "
               "popularity AS tmdb_popularity, rated AS age_rating), coalesce(tmdb_runtime, omdb_runtime) AS runtime_in_min FROM star_v",
    "flag_v": "SELECT *, CAST(budget IS NULL AS INT) AS budget_missing, CAST(revenue IS NULL AS INT) AS revenue_missing, "
              "CAST(year(release_date) AS INT) AS release_year FROM model_v",
}


def with_views(body: str, **extra: str) -> str:
    """``body`` preceded by the views; ``extra`` adds further ones after them."""
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in {**CTES, **extra}.items()) + " " + body
