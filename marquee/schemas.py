"""Table contracts and payload schemas."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import types as T

from marquee.functions.dates import stamp

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOL, DATE, STAMP = T.BooleanType(), T.DateType(), T.TimestampNTZType()


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


MOVIES = _table(
    ("movie_id", INT), ("tmdb_id", INT), ("imdb_id", STRING), ("title", STRING), ("release_date", DATE),
    ("created_at", STAMP), ("last_full_refresh", STAMP), ("last_tmdb_update", STAMP),
    ("last_omdb_update", STAMP), ("last_numbers_update", STAMP), ("data_frozen", BOOL),
)

TMDB_MOVIES = _table(
    ("tmdb_id", INT), ("imdb_id", STRING), ("title", STRING), ("release_date", DATE), ("status", STRING),
    ("budget", LONG), ("revenue", LONG), ("runtime", INT), ("vote_count", INT), ("vote_average", DOUBLE),
    ("popularity", DOUBLE), ("genres", STRING), ("production_companies", STRING),
    ("production_countries", STRING), ("spoken_languages", STRING), ("overview", STRING),
    ("last_updated_utc", STAMP),
)

OMDB_MOVIES = _table(
    ("imdb_id", STRING), ("title", STRING), ("year", INT), ("genre", STRING), ("director", STRING),
    ("writer", STRING), ("actors", STRING), ("imdb_rating", DOUBLE), ("imdb_votes", INT), ("metascore", INT),
    ("box_office", LONG), ("released", STRING), ("runtime", INT), ("language", STRING), ("country", STRING),
    ("rated", STRING), ("awards", STRING), ("rotten_tomatoes_rating", INT), ("meta_critic_rating", INT),
    ("last_updated_utc", STAMP),
)

NUMBERS_MOVIES = _table(
    ("movie_id", INT), ("domestic_box_office", LONG), ("international_box_office", LONG),
    ("worldwide_box_office", LONG), ("release_year", INT), ("production_budget", LONG),
    ("opening_weekend_box_office", LONG), ("last_updated_utc", STAMP),
)

REFRESH_STATE = _table(
    ("movie_id", INT), ("refresh_interval_days", INT), ("next_refresh_due", STAMP),
    ("freeze_after_days", INT), ("frozen", BOOL), ("last_checked", STAMP),
)

TABLES = {
    "movies": MOVIES,
    "tmdb_movies": TMDB_MOVIES,
    "omdb_movies": OMDB_MOVIES,
    "numbers_movies": NUMBERS_MOVIES,
    "movie_refresh_state": REFRESH_STATE,
}

# Primary keys, and column defaults for rows that do not name the column.
TABLE_KEYS = {
    "movies": ["tmdb_id"],
    "tmdb_movies": ["tmdb_id"],
    "omdb_movies": ["imdb_id"],
    "numbers_movies": ["movie_id"],
    "movie_refresh_state": ["movie_id"],
}
TABLE_DEFAULTS = {
    "movies": {"data_frozen": False},
    "movie_refresh_state": {"refresh_interval_days": 30, "freeze_after_days": 365, "frozen": False},
}
# Columns that take the time of the change in rows that do not name them.
CHANGE_STAMPS = {"movies": ["created_at"]}


def table_defaults(table: str, as_of: dt.datetime) -> dict[str, Any]:
    """Defaults of a table by its bare or qualified name, for a change made at ``as_of``."""
    bare = table.replace("`", "").rpartition(".")[2]
    return {**TABLE_DEFAULTS.get(bare, {}), **{c: stamp(as_of) for c in CHANGE_STAMPS.get(bare, [])}}

DISCOVER_ITEM = _table(
    ("id", LONG), ("title", STRING), ("release_date", STRING), ("vote_count", LONG), ("vote_average", DOUBLE),
    ("popularity", DOUBLE), ("genre_ids", T.ArrayType(LONG)), ("adult", BOOL), ("video", BOOL),
)
DISCOVER_PAGE = _table(("results", T.ArrayType(DISCOVER_ITEM)), ("total_pages", INT))

_NAMED = _table(("id", LONG), ("name", STRING))
DETAILS = _table(
    ("id", LONG), ("imdb_id", STRING), ("title", STRING), ("release_date", STRING), ("status", STRING),
    ("budget", LONG), ("revenue", LONG), ("runtime", INT), ("vote_count", LONG), ("vote_average", DOUBLE),
    ("popularity", DOUBLE), ("genres", T.ArrayType(_NAMED)),
    ("production_companies", T.ArrayType(_table(
        ("id", LONG), ("name", STRING), ("logo_path", STRING), ("origin_country", STRING)))),
    ("production_countries", T.ArrayType(_table(("iso_3166_1", STRING), ("name", STRING)))),
    ("spoken_languages", T.ArrayType(_table(
        ("english_name", STRING), ("iso_639_1", STRING), ("name", STRING)))),
    ("overview", STRING),
)

TITLE = T.StructType(
    [T.StructField(name, STRING) for name in (
        "Response", "imdbID", "Title", "Year", "Genre", "Director", "Writer", "Actors", "imdbRating",
        "imdbVotes", "Metascore", "BoxOffice", "Released", "Runtime", "Language", "Country", "Rated",
        "Awards", "Error")]
    + [T.StructField("Ratings", T.ArrayType(_table(("Source", STRING), ("Value", STRING))))]
)

# Fields a payload must carry to be stored.
REQUIRED = {
    "discover": ["id", "title", "vote_count", "vote_average", "popularity", "genre_ids"],
    "details": ["id", "title", "status", "budget", "revenue", "vote_count", "vote_average", "popularity",
                "genres", "production_companies", "production_countries", "spoken_languages"],
    "title": ["Response"],
}
