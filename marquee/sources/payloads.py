"""Landed API payloads: typed reads, validation and flat rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from marquee.functions import parse
from marquee.functions.dates import stamp, year_bounds
from marquee.schemas import DETAILS, DISCOVER_PAGE, REQUIRED, TITLE

PAYLOADS = {"discover": DISCOVER_PAGE, "details": DETAILS, "title": TITLE}
# Fields that each element of a nested list must carry.
NESTED_REQUIRED = {
    "genres": ["id", "name"],
    "production_companies": ["id", "name", "origin_country"],
    "production_countries": ["iso_3166_1", "name"],
    "spoken_languages": ["english_name", "iso_639_1", "name"],
    "Ratings": ["Source", "Value"],
}
PAGE_ROWS = 20


def _corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])


def read_payloads(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """JSON lines of one payload kind; a line that does not fit keeps its text in _corrupt_record."""
    rows = spark.read.schema(_corrupt(PAYLOADS[kind])).json(path)
    return explode_discover(rows) if kind == "discover" else rows


def explode_discover(pages: DataFrame) -> DataFrame:
    """One row per listed movie; a page that could not be parsed stays as one corrupt row."""
    return pages.select(F.explode_outer("results").alias("item"), "_corrupt_record").where(
        "item is not null or _corrupt_record is not null").select("item.*", "_corrupt_record")


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _whole_elements(name: str, fields: list[str]) -> Column:
    return F.forall(name, lambda e: e.isNotNull() & _all([e[f].isNotNull() for f in fields]))


def valid_payload(df: DataFrame, kind: str) -> Column:
    """True where every required field is present, nested ones included."""
    checks = [F.col(c).isNotNull() for c in REQUIRED[kind]]
    if "_corrupt_record" in df.columns:
        checks.append(F.col("_corrupt_record").isNull())
    for name, fields in NESTED_REQUIRED.items():
        if name in df.columns:
            checks.append(F.coalesce(_whole_elements(name, fields), F.lit(True)))
    if kind == "discover":
        checks.append(F.forall("genre_ids", lambda g: g.isNotNull()))
    return F.coalesce(_all(checks), F.lit(False))


def quarantine(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows)."""
    ok = valid_payload(df, kind)
    return df.where(ok), df.where(~ok)


def ingest_stamp(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One timestamp for the whole batch."""
    return df.withColumn("last_updated_utc", stamp(as_of))


def normalize_discover(items: DataFrame, as_of: dt.datetime, carry: Sequence[str] = ()) -> DataFrame:
    """Flat discover rows; ``carry`` names further columns to keep."""
    rows = items.select(
        F.col("id").alias("tmdb_id"), "title", "release_date", "vote_count", "vote_average", "popularity",
        F.array_join(F.transform("genre_ids", lambda g: g.cast("string")), ",").alias("genre_ids"), *carry)
    return ingest_stamp(rows, as_of)


def _names(column: str, field: str = "name") -> Column:
    return F.array_join(F.transform(column, lambda e: e[field]), ",")


def normalize_details(details: DataFrame, as_of: dt.datetime, carry: Sequence[str] = ()) -> DataFrame:
    """Flat detail rows: object lists become comma-joined names."""
    rows = details.select(
        F.col("id").alias("tmdb_id"), "imdb_id", "title", "release_date", "status", "budget", "revenue", "runtime",
        "vote_count", "vote_average", "popularity",
        _names("genres").alias("genres"), _names("production_companies").alias("production_companies"),
        _names("production_countries").alias("production_countries"),
        _names("spoken_languages", "english_name").alias("spoken_languages"), "overview", *carry)
    return ingest_stamp(rows, as_of)


def normalize_titles(titles: DataFrame, as_of: dt.datetime, carry: Sequence[str] = ()) -> DataFrame:
    """Typed title rows; error answers are left out."""
    rows = titles.where("Response <> 'False'").select(
        F.col("imdbID").alias("imdb_id"), F.col("Title").alias("title"), parse.parse_digits("Year").alias("year"),
        F.col("Genre").alias("genre"), F.col("Director").alias("director"), F.col("Writer").alias("writer"),
        F.col("Actors").alias("actors"), parse.parse_rating("imdbRating").alias("imdb_rating"),
        parse.parse_votes("imdbVotes").alias("imdb_votes"), parse.parse_digits("Metascore").alias("metascore"),
        parse.parse_money("BoxOffice").alias("box_office"), F.col("Released").alias("released"),
        parse.parse_minutes("Runtime").alias("runtime"), F.col("Language").alias("language"),
        F.col("Country").alias("country"), F.col("Rated").alias("rated"), F.col("Awards").alias("awards"),
        parse.rotten_tomatoes("Ratings").alias("rotten_tomatoes_rating"),
        parse.metacritic("Ratings").alias("meta_critic_rating"), *carry)
    return ingest_stamp(rows, as_of)


def discover_filter(items: DataFrame, start: int, end: int | None = None, min_votes: int = 200,
                    max_pages: int | None = None) -> DataFrame:
    """Releases of the years start..end with enough votes, no adult or video titles, one row per id.

    ``max_pages`` keeps the newest pages of each year. Years are few and may be huge, so the cut is a
    top-k per year rather than a sort of each year in one task.
    """
    end = end or start
    first, after = year_bounds(start, end)
    day = F.col("release_date").try_cast("date")
    rows = items.where((day >= first) & (day < after) & (F.col("vote_count") >= min_votes)).where(
        ~F.coalesce("adult", F.lit(False)) & ~F.coalesce("video", F.lit(False)))
    # The same movie may sit on two pages; the richer copy stays.
    rest = [c for c in rows.columns if c != "id"]
    rows = rows.groupBy("id").agg(F.max(F.struct("vote_count", *[c for c in rest if c != "vote_count"])).alias("r"))
    rows = rows.select("id", *[F.col(f"r.{c}").alias(c) for c in rest]).select(*items.columns)
    if max_pages is None:
        return rows
    # One ranking for all years; Spark keeps each partition's first rows of a year before the shuffle.
    newest = Window.partitionBy(F.year(day)).orderBy(day.desc(), F.col("id"))
    return rows.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= max_pages * PAGE_ROWS).drop("__rank")
