"""Calendar columns and age rules."""

from __future__ import annotations

import datetime as dt
from itertools import chain

from pyspark.sql import Column, functions as F

from marquee.functions.text import col

# Age bounds in days, and refresh intervals in days per source and age.
AGE_BOUNDS = {"recent": 60, "established": 180, "mature": 365}
INTERVALS = {
    "tmdb": {"recent": 5, "established": 15, "mature": 30, "archived": 90},
    "omdb": {"recent": 5, "established": 30, "mature": 90, "archived": 180},
    "numbers": {"recent": 5, "established": 30, "mature": 90, "archived": 180},
}
FREEZE_MIN_AGE_DAYS = 365
FREEZE_STABLE_CYCLES = 3
HOLIDAY_MONTHS = (6, 7, 11, 12)


def stamp(as_of: dt.datetime) -> Column:
    """``as_of`` as a zone-free UTC timestamp literal."""
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def today(as_of: dt.datetime) -> Column:
    return stamp(as_of).cast("date")


def days_since(c: Column | str, as_of: dt.datetime) -> Column:
    """Calendar days between the column's date and ``as_of``."""
    return F.datediff(today(as_of), col(c).cast("date"))


def age_category(release: Column | str, as_of: dt.datetime) -> Column:
    """recent / established / mature / archived; NULL without a date, recent for future dates."""
    days = days_since(release, as_of)
    case = F.when(days <= AGE_BOUNDS["recent"], "recent")
    case = case.when(days <= AGE_BOUNDS["established"], "established")
    case = case.when(days <= AGE_BOUNDS["mature"], "mature")
    return case.when(days.isNotNull(), "archived")


def refresh_interval(release: Column | str, source: str, as_of: dt.datetime) -> Column:
    """Days between refreshes, by age and source."""
    policy = F.create_map(*[F.lit(v) for v in chain.from_iterable(INTERVALS[source].items())])
    return policy[age_category(release, as_of)]


def date_feature_columns(release: Column | str, as_of_year: int) -> dict[str, Column]:
    d = col(release).cast("date")
    return {
        "release_year": F.year(d),
        "release_month": F.month(d),
        "release_day": F.day(d),
        "is_weekend": F.coalesce((F.weekday(d) >= 4).cast("int"), F.lit(0)),
        "is_holiday_season": F.coalesce(F.month(d).isin(*HOLIDAY_MONTHS).cast("int"), F.lit(0)),
        "movie_age": F.lit(as_of_year) - F.year(d),
    }


def year_bounds(start: int, end: int) -> tuple[Column, Column]:
    """First day of ``start`` and first day after ``end`` as literals, so filters reach the scan."""
    return F.lit(dt.date(start, 1, 1)), F.lit(dt.date(end + 1, 1, 1))
