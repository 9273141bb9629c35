"""Column expressions on strings and comma-separated labels."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# The characters Python's str.strip() removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of whitespace; plain ``trim`` handles spaces only."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def split_labels(c: Column | str, delimiter: str = ",") -> Column:
    """Labels of a delimited string, whitespace after a delimiter dropped, otherwise untrimmed."""
    return F.split(col(c), rf"(?U){delimiter}\s*")


def stripped_labels(c: Column | str, delimiter: str = ",") -> Column:
    return F.transform(F.split(col(c), delimiter), strip)


def contains_text(c: Column | str, needle: str) -> Column:
    """Case-insensitive substring test; missing text is a miss."""
    return F.coalesce(F.lower(col(c)).contains(needle.lower()), F.lit(False))


def nth_label(c: Column | str, n: int, delimiter: str = ",") -> Column:
    """The n-th (from 0) delimited item, trimmed; NULL where absent."""
    return strip(F.get(F.split(col(c), delimiter), F.lit(n)))


@F.pandas_udf(T.StringType())
def _ascii_fold(s: pd.Series) -> pd.Series:
    # Spark SQL has no Unicode decomposition.
    return s.map(
        lambda v: unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii"), na_action="ignore"
    )


def slugify(c: Column | str) -> Column:
    """URL slug: ASCII letters, punctuation dropped, whitespace runs as hyphens."""
    words = F.regexp_replace(_ascii_fold(col(c)), r"[^\w\s-]", "")
    return F.regexp_replace(words, r"\s+", "-")
