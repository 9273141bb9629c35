"""Typed values out of the text fields of title payloads. Unparseable text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marquee.functions.text import col, strip

# What the payloads use for "missing", and the two rating sources that are kept.
MISSING_MARKS = ("", "N/A")
ROTTEN_TOMATOES = "Rotten Tomatoes"
METACRITIC = "Metacritic"


def na_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~c.isin(*MISSING_MARKS), c)


def _whole(c: Column, kind: str) -> Column:
    """Signed whole number with surrounding whitespace allowed."""
    text = strip(c)
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast(kind))


def parse_money(c: Column | str) -> Column:
    """'$1,234' -> 1234."""
    return _whole(F.regexp_replace(na_to_null(c), "[$,]", ""), "bigint")


def parse_minutes(c: Column | str) -> Column:
    """'142 min' -> 142: the first whitespace-separated word."""
    words = F.split(strip(na_to_null(c)), r"(?U)\s+")
    return _whole(F.get(words, F.lit(0)), "int")


def parse_digits(c: Column | str) -> Column:
    """Digits only: serves the year and metascore fields."""
    c = col(c)
    return F.when(c.rlike(r"^[0-9]+\z"), c.try_cast("int"))


def parse_rating(c: Column | str) -> Column:
    """Digits with at most one point."""
    c = col(c)
    return F.when(c.rlike(r"^(?=.*[0-9])[0-9]*\.?[0-9]*\z"), c.try_cast("double"))


def parse_votes(c: Column | str) -> Column:
    """'1,234,567' -> 1234567."""
    return _whole(F.regexp_replace(col(c), ",", ""), "int")


def parse_number(c: Column | str) -> Column:
    """Any decimal number, commas dropped; words such as 'nan' or a suffix such as '1d' give NULL."""
    text = strip(F.regexp_replace(col(c).cast("string"), ",", ""))
    return F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"), text.try_cast("double"))


def _last_parsed(ratings: Column, source: str, parse) -> Column:
    values = F.transform(
        F.filter(ratings, lambda r: r["Source"] == source), lambda r: parse(r["Value"])
    )
    return F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(-1))


def rotten_tomatoes(ratings: Column | str) -> Column:
    """The last parseable '85%' of the source."""
    def percent(v: Column) -> Column:
        return F.when(v.endswith("%"), _whole(F.regexp_replace(v, r"%+\z", ""), "int"))

    return _last_parsed(col(ratings), ROTTEN_TOMATOES, percent)


def metacritic(ratings: Column | str) -> Column:
    """The last parseable '76/100' of the source."""
    def fraction(v: Column) -> Column:
        return F.when(v.contains("/"), _whole(F.substring_index(v, "/", 1), "int"))

    return _last_parsed(col(ratings), METACRITIC, fraction)


# Award patterns. The (?U) class mode and (?d) line mode match the source dialect.
_FLAGS = "(?iUd)"
AWARD_PATTERNS = {
    "total_wins": r"(\d+)\s+wins?(?!.*Oscars)",
    "total_noms": r"(\d+)\s+nominations",
    "oscar_wins": r"Oscars?[\W_]+(\d+)\s+wins?",
    "oscar_noms": r"Nominated for\s+(\d+)\s+Oscars?",
    "bafta_wins": r"BAFTA(?:\s+Award)?[\D_]+(\d+)\s+wins?",
    "bafta_noms": r"Nominated for\s+(\d+)\s*BAFTA",
}


def award_columns(c: Column | str) -> list[Column]:
    """Six counts read from an awards sentence; 0 where the sentence says nothing."""
    text = col(c)
    return [
        F.coalesce(F.regexp_extract(text, _FLAGS + pattern, 1).try_cast("int"), F.lit(0)).alias(name)
        for name, pattern in AWARD_PATTERNS.items()
    ]
