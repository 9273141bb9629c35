"""Scaling and categorical encoders, fitted on one frame and applied to others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.text import stripped_labels
from marquee.operators.features import FittedStep
from marquee.operators.ranking import with_dense_index

# The modelling columns and the code of an unseen category.
SCALED = ["metascore", "rotten_tomatoes_rating", "meta_critic_rating", "budget", "tmdb_vote_count",
          "tmdb_vote_average", "runtime_in_min", "tmdb_popularity", "imdb_rating", "imdb_votes", "total_wins",
          "total_noms", "oscar_wins", "oscar_noms", "bafta_wins", "bafta_noms", "release_year", "release_month",
          "release_day", "movie_age"]
ONE_HOT = ["age_rating"]
ORDINAL = ["first_billing_actor", "second_billing_actor", "third_billing_actor", "main_director", "main_writer",
           "secondary_writer"]
MULTI_LABEL = ["genre_names", "production_country_name", "spoken_languages"]
UNSEEN = 999999
SLOTS = 1024


def label_items(c: str, delimiter: str = ",") -> Column:
    """Trimmed items with spaces as underscores; an empty list for a missing cell."""
    items = F.transform(stripped_labels(c, delimiter), lambda v: F.replace(v, F.lit(" "), F.lit("_")))
    return F.coalesce(items, F.array().cast("array<string>"))


def _attach(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """``df`` with the other columns of ``side`` (``__value``, …), matched on ``key``; rows without a key are spread."""
    slot = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(SLOTS)) + 1).otherwise(F.lit(0))
    placed = df.withColumn("__slot", slot).withColumn("__key", F.coalesce(F.col(key), F.lit("").cast(df.schema[key].dataType)))
    # Keyless rows stand in slots that the right side does not have.
    return placed.join(side.withColumn("__rslot", F.lit(0)), F.expr("__key = __value AND __slot = __rslot"), "left").drop(
        "__slot", "__key", "__value", "__rslot")


def _dictionary(values: DataFrame) -> DataFrame:
    """(__value, __code): positions in sorted order. It can grow with the data, so it stays a table."""
    return with_dense_index(values, [F.col("__value")], "__code")


class MultiLabelBinarizer(Estimator):
    """The labels of a cell as one sorted array of codes, ``<prefix>_codes``; unseen labels are ignored.

    Codes are positions in the sorted dictionary, which is learned as a table (``learned["codes"]``); the output has
    this form whatever the number of labels. ``multilabel_columns`` gives 0/1 columns for a given label list.
    """

    def __init__(self, column: str, delimiter: str = ",", prefix: str | None = None):
        super().__init__()
        self.column, self.delimiter, self.prefix = column, delimiter, prefix or column

    def _fit(self, dataset: DataFrame) -> FittedStep:
        items = label_items(self.column, self.delimiter)
        codes = _dictionary(dataset.select(F.explode(items).alias("__value")).distinct())
        out = f"{self.prefix}_codes"

        def apply(df: DataFrame) -> DataFrame:
            # Every distinct cell is translated once.
            cells = df.select(F.col(self.column).alias("__cell")).where("__cell is not null").distinct()
            pieces = cells.select("__cell", F.explode(F.array_distinct(label_items("__cell", self.delimiter))).alias("__value"))
            side = pieces.join(codes, "__value").groupBy(F.col("__cell")).agg(F.sort_array(F.collect_list("__code")).alias("__codes"))
            coded = _attach(df, side.withColumnRenamed("__cell", "__value"), self.column)
            return coded.withColumn(out, F.coalesce("__codes", F.array().cast("array<bigint>"))).drop("__codes", self.column)

        return FittedStep(apply, codes=codes)


def multilabel_columns(df: DataFrame, column: str, labels: Sequence[str], delimiter: str = ",", prefix: str | None = None) -> DataFrame:
    """One 0/1 column ``<prefix>_<label>`` for each of the given labels, in place of ``column``."""
    flags = [F.array_contains("__items", v).cast("int").alias(f"{prefix or column}_{v}") for v in labels]
    rest = [c for c in df.columns if c != column]
    return df.withColumn("__items", label_items(column, delimiter)).select(*rest, *flags)


class StandardScaler(Estimator):
    """Zero mean and unit population deviation; a constant column is only centred."""

    def __init__(self, columns: Sequence[str] = SCALED):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, dataset: DataFrame) -> FittedStep:
        cells = dataset.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in self.columns])
        row = cells.agg(*[f(c).alias(f"{n}_{c}") for c in self.columns
                          for n, f in (("mean", F.avg), ("std", F.stddev_pop))]).first()
        stats = {c: (row[f"mean_{c}"], row[f"std_{c}"] or 1.0) for c in self.columns}

        def apply(df: DataFrame) -> DataFrame:
            return df.withColumns({
                c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(std) for c, (mean, std) in stats.items()})

        return FittedStep(apply, stats=stats)


class OneHotEncoder(Estimator):
    """The place of a cell's one, ``<column>_code``: positions in sorted order, a missing cell as the last category.

    Unseen categories, and missing cells where none was seen, have no one: NULL. ``one_hot_columns`` gives 0/1 columns
    for a given category list.
    """

    def __init__(self, column: str = "age_rating"):
        super().__init__()
        self.column = column

    def _fit(self, dataset: DataFrame) -> FittedStep:
        c = F.col(self.column)
        codes = _dictionary(dataset.where(c.isNotNull()).select(c.alias("__value")).distinct())
        seen = dataset.agg(F.count_if(c.isNull()).alias("missing"), F.count_distinct(c).alias("known")).first()
        last = F.lit(seen["known"] if seen["missing"] else None).cast("bigint")

        def apply(df: DataFrame) -> DataFrame:
            code = F.when(c.isNull(), last).otherwise(F.col("__code"))
            return _attach(df, codes, self.column).withColumn(f"{self.column}_code", code).drop("__code", self.column)

        return FittedStep(apply, codes=codes, missing=bool(seen["missing"]))


def one_hot_columns(df: DataFrame, column: str, categories: Sequence[str], missing: bool = True) -> DataFrame:
    """One 0/1 column for each of the given categories, and ``<column>_None`` for missing cells, in place of ``column``."""
    c = F.col(column)
    flags = [F.coalesce(c == v, F.lit(False)).cast("int").alias(f"{column}_{v}") for v in categories]
    if missing:
        flags.append(c.isNull().cast("int").alias(f"{column}_None"))
    return df.select(*[n for n in df.columns if n != column], *flags)


class OrdinalEncoder(Estimator):
    """Position of a category in sorted order; unseen gives 999999, missing stays missing.

    The category list can grow with the data, so it stays a table: indexed by a range sort and joined,
    never collected or force-broadcast.
    """

    def __init__(self, columns: Sequence[str] = ORDINAL, unseen: int = UNSEEN):
        super().__init__()
        self.columns, self.unseen = list(columns), unseen

    def _fit(self, dataset: DataFrame) -> FittedStep:
        tables = {c: _dictionary(dataset.where(F.col(c).isNotNull()).select(F.col(c).alias("__value")).distinct()) for c in self.columns}

        def apply(df: DataFrame) -> DataFrame:
            out = df
            for c, codes in tables.items():
                code = F.when(F.col(c).isNotNull(), F.coalesce("__code", F.lit(self.unseen))).cast("double")
                out = _attach(out, codes, c).withColumn(c, code).drop("__code")
            return out

        return FittedStep(apply, tables=tables)
