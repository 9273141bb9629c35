"""Row-wise features, and steps that are fitted on one frame and applied to others."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.sql import DataFrame, functions as F, types as T

from marquee.functions.dates import date_feature_columns
from marquee.functions.parse import award_columns, parse_number
from marquee.functions.text import nth_label, stripped_labels
from marquee.operators.explore import top_label_list
from marquee.operators.ranking import exact_quantiles

# Which billing positions are kept, and under which names.
BILLING = {
    "actors": ["first_billing_actor", "second_billing_actor", "third_billing_actor", "forth_billing_actor"],
    "director": ["main_director", "secondary_director"],
    "writer": ["main_writer", "secondary_writer"],
}
UNKNOWN_COLUMNS = ["production_company_name", "production_country_name", "spoken_languages", "director", "writer",
                   "actors", "age_rating"]
ZERO_COLUMNS = ["imdb_rating", "imdb_votes"]
FLAGGED_COLUMNS = ["metascore", "rotten_tomatoes_rating", "meta_critic_rating", "budget", "revenue"]
DROPPED_COLUMNS = ["production_company_name", "director", "writer", "actors", "title", "release_date"]


def missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_missing`` as 0/1."""
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in columns})


def to_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: parse_number(c) for c in columns})


def award_features(df: DataFrame, column: str = "awards") -> DataFrame:
    """Replace the awards sentence with its six counts."""
    return df.select(*[c for c in df.columns if c != column], *award_columns(column))


def date_features(df: DataFrame, column: str = "release_date", as_of_year: int = 2025) -> DataFrame:
    return df.withColumns(date_feature_columns(column, as_of_year))


def roi(df: DataFrame) -> DataFrame:
    """(revenue - budget) / budget; NULL for a zero budget."""
    gain = (F.col("revenue") - F.col("budget")).cast("double")
    return df.withColumn("roi", F.try_divide(gain, F.col("budget").cast("double")))


def billing(df: DataFrame, columns: Mapping[str, Sequence[str]] = BILLING) -> DataFrame:
    """Split people lists into billing positions and drop the lists."""
    named = {name: nth_label(source, i) for source, names in columns.items() for i, name in enumerate(names)}
    return df.withColumns(named).drop(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str] = DROPPED_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def impute_constant(df: DataFrame, text: Sequence[str] = UNKNOWN_COLUMNS, numbers: Sequence[str] = ZERO_COLUMNS,
                    label: str = "Unknown") -> DataFrame:
    """Missing text becomes ``label``, missing numbers (NaN included) become 0."""
    fills = {c: F.coalesce(c, F.lit(label)) for c in text}
    for c in numbers:
        plain = F.nanvl(F.col(c), F.lit(None)) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)
        fills[c] = F.coalesce(plain, F.lit(0).cast(df.schema[c].dataType))
    return df.withColumns(fills)


def column_select(df: DataFrame, kind: str) -> list[str]:
    """Names of the numeric or the text columns."""
    types = {"number": T.NumericType, "text": T.StringType}[kind]
    return [f.name for f in df.schema if isinstance(f.dataType, types)]


class FrameStep(Transformer):
    """A frame-to-frame function as a stage of ``pyspark.ml.Pipeline``."""

    def __init__(self, apply: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.apply = apply

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.apply(dataset)


class FittedStep(Model):
    """What a fitted stage applies."""

    def __init__(self, apply: Callable[[DataFrame], DataFrame], **learned):
        super().__init__()
        self.apply = apply
        self.learned = learned

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.apply(dataset)


class MedianImputer(Estimator):
    """Fill missing cells with the exact median of the fitted frame."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, dataset: DataFrame) -> FittedStep:
        rows = exact_quantiles(dataset, self.columns, [0.5]).collect()  # one row per column
        medians = {r["feature"]: r["quantiles"][0] for r in rows}

        def apply(df: DataFrame) -> DataFrame:
            return df.withColumns({
                c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(m)) for c, m in medians.items()})

        return FittedStep(apply, medians=medians)


class RareLabelGrouper(Estimator):
    """Keep the n most frequent labels of comma-separated columns; all others become one label."""

    def __init__(self, top: Mapping[str, int], others: str = "Others", delimiter: str = ","):
        super().__init__()
        self.top, self.others, self.delimiter = dict(top), others, delimiter

    def _fit(self, dataset: DataFrame) -> FittedStep:
        kept = {c: top_label_list(dataset, c, n) for c, n in self.top.items()}

        def grouped(c: str):
            known = F.array(*[F.lit(v) for v in kept[c]]).cast("array<string>")
            labels = F.transform(
                stripped_labels(c, self.delimiter),
                lambda v: F.when(F.array_contains(known, v), v).otherwise(F.lit(self.others)))
            return F.array_join(F.array_distinct(labels), self.delimiter)

        return FittedStep(lambda df: df.withColumns({c: grouped(c) for c in kept}), labels=kept)
