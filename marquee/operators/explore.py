"""Counts, distributions and label statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.functions.text import split_labels, strip
from marquee.operators.joins import company_rows
from marquee.operators.ranking import exact_quantiles, melt_numeric, value_profile
from marquee.session import materialize


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(df.columns)])
    return counted.select(F.inline(rows))


def missing_overlap(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows missing both, only ``a``, only ``b``, or any."""
    na, nb = F.col(a).isNull(), F.col(b).isNull()
    return df.agg(
        F.count_if(na & nb).alias("both_missing"), F.count_if(na & ~nb).alias(f"only_{a}_missing"),
        F.count_if(nb & ~na).alias(f"only_{b}_missing"), F.count_if(na | nb).alias("any_missing"))


def missing_rate_by_year(df: DataFrame, a: str, b: str, date: str = "release_date") -> DataFrame:
    """Share of rows missing both columns, per release year."""
    both = (F.col(a).isNull() & F.col(b).isNull()).cast("int")
    return df.where(F.col(date).isNotNull()).groupBy(F.year(date).alias("release_year")).agg(F.avg(both).alias("missing_rate"))


def melt_labels(df: DataFrame, columns: Sequence[str], trimmed: bool = True) -> DataFrame:
    """Rows (feature, label) for every label of the comma-separated ``columns``."""
    lists = F.array(*[F.struct(F.lit(c).alias("feature"), split_labels(c).alias("labels")) for c in columns])
    rows = df.select(F.inline(lists)).select("feature", F.explode("labels").alias("label"))
    return rows.withColumn("label", strip("label")) if trimmed else rows


def label_cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Number of distinct untrimmed labels per column."""
    count = F.approx_count_distinct("label") if approximate else F.count_distinct("label")
    return melt_labels(df, columns, trimmed=False).groupBy("feature").agg(count.alias("labels"))


def label_counts(df: DataFrame, columns: Sequence[str], trimmed: bool = True) -> DataFrame:
    return melt_labels(df, columns, trimmed).groupBy("feature", "label").agg(F.count("*").alias("n"))


def top_labels(df: DataFrame, top: Mapping[str, int], others: str = "Others") -> DataFrame:
    """Per column the n most frequent labels (ties by label) and one row with the total of the rest.

    The rank filter is pushed below the shuffle as a per-partition limit, so a column with very many
    labels does not meet in one task.
    """
    counts = materialize(label_counts(df, list(top)), "label-counts")  # read three times below
    wanted = reduce(lambda case, kv: case.when(F.col("feature") == kv[0], kv[1]), top.items(), F)
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "label"))
    best = (
        counts.withColumn("pos", rank).where(F.col("pos") <= max(top.values())).where(F.col("pos") <= wanted)
    )
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    kept = best.groupBy("feature").agg(F.sum("n").alias("kept"))
    rest = totals.join(kept, "feature").select(
        "feature", F.lit(others).alias("label"), (F.col("total") - F.col("kept")).alias("n"),
        F.lit(None).cast("int").alias("pos"))
    return best.select("feature", "label", "n", "pos").unionByName(rest)


def top_label_list(df: DataFrame, column: str, n: int) -> list[str]:
    """The n most frequent trimmed labels, most frequent first, ties by label."""
    rows = label_counts(df, [column]).orderBy(F.desc("n"), "label").limit(n).select("label").collect()
    return [r[0] for r in rows]


def value_counts(df: DataFrame, column: str, share: bool = False) -> DataFrame:
    """Non-missing values with their counts, most frequent first; optionally with their share."""
    known = df.where(F.col(column).isNotNull())
    counts = known.groupBy(column).agg(F.count("*").alias("n"))
    if share:
        counts = materialize(counts, "value-counts")
        counts = counts.withColumn("share", F.col("n") / counts.agg(F.sum("n").alias("total")).scalar())
    return counts.orderBy(F.desc("n"), column)


def counts_by_period(df: DataFrame, period: str = "year", date: str = "release_date") -> DataFrame:
    """Rows per release year or month."""
    part = {"year": F.year, "month": F.month}[period](date)
    return df.where(F.col(date).isNotNull()).groupBy(part.alias(f"release_{period}")).agg(F.count("*").alias("n"))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation and exact quartiles per column."""
    names = ["min", "q25", "median", "q75", "max"]
    profile = value_profile(df, columns, [0.0, 0.25, 0.5, 0.75, 1.0])
    return profile.select("feature", "count", "mean", "std", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)])


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bin counts per column, the last bin closed; empty bins are listed with 0.

    A constant column is widened by one half on each side.
    """
    values = melt_numeric(df, columns)
    bounds = values.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    bounds = bounds.select("feature", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                           F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    # One row per column on the right.
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    binned = values.join(F.broadcast(bounds), "feature").groupBy(
        "feature", F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    frame = bounds.select("feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(binned, ["feature", "bin"], "left").select(
        "feature", "bin", (F.col("lo") + width * F.col("bin")).alias("left_edge"),
        F.coalesce("n", F.lit(0)).alias("n"))


def _fences(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    spread = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    q1, q2, q3 = [F.col("quantiles")[i] for i in range(3)]
    reach = (q3 - q1) * 1.5
    return spread.select("feature", q1.alias("q1"), q2.alias("median"), q3.alias("q3"),
                         (q1 - reach).alias("low_fence"), (q3 + reach).alias("high_fence"))


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (outermost values within 1.5 IQR) and the number of outliers per column."""
    df = materialize(df.select(*columns), "box-cells")  # read three times
    fences = _fences(df, columns)  # one row per column
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    value = F.when(inside, F.col("value"))
    return melt_numeric(df, columns).join(F.broadcast(fences), "feature").groupBy(
        "feature", "q1", "median", "q3").agg(
        F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"), F.count_if(~inside).alias("outliers"))


def outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values outside the fences, as (feature, value) rows."""
    df = materialize(df.select(*columns), "outlier-cells")  # read three times
    fences = F.broadcast(_fences(df, columns).select("feature", "low_fence", "high_fence"))
    outside = ~F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return melt_numeric(df, columns).join(fences, "feature").where(outside).select("feature", "value")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over the rows that have both.

    Rows are grouped by which columns they have; the sums of a group serve every pair it has, so the
    data is read once with one product per pair instead of five running values. Columns are centred on
    their means first, which keeps the sums small. Returned long, both orders and the diagonal included.
    """
    k = range(len(columns))
    cells = df.selectExpr(*[f"nanvl(CAST(`{c}` AS DOUBLE), NULL) AS x{i}" for i, c in enumerate(columns)])
    means = cells.selectExpr(*[f"avg(x{i}) AS m{i}" for i in k]).first()
    has = "concat(" + ", ".join(f"if(x{i} IS NULL, '0', '1')" for i in k) + ")"
    centred = cells.selectExpr(f"{has} AS has", *[
        f"coalesce(x{i} - CAST({means[i] or 0.0!r} AS DOUBLE), 0D) AS x{i}" for i in k])
    pairs = [(i, j) for i in k for j in k if i <= j]
    groups = centred.groupBy("has").agg(
        F.expr("CAST(count(*) AS DOUBLE) AS n"), *[F.expr(f"sum(x{i}) AS s{i}") for i in k],
        *[F.expr(f"sum(x{i} * x{j}) AS p{i}_{j}") for i, j in pairs])
    # From here on there is at most one row per set of present columns.
    entries = ", ".join(
        f"struct({i} AS i, {j} AS j, n, s{i} AS si, s{j} AS sj, p{i}_{i} AS sii, p{j}_{j} AS sjj, p{i}_{j} AS sij)" for i, j in pairs)
    rows = groups.selectExpr("has", f"inline(array({entries}))").where("substr(has, i + 1, 1) = '1' AND substr(has, j + 1, 1) = '1'")
    sums = rows.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sii", "sjj", "sij")])
    corr = "try_divide(n * sij - si * sj, sqrt((n * sii - si * si) * (n * sjj - sj * sj))) AS corr"
    orders = "explode(array_distinct(array(struct(i AS a, j AS b), struct(j AS a, i AS b)))) AS at"
    names = F.array(*[F.lit(c) for c in columns])
    return sums.selectExpr(corr, orders).select(
        names[F.col("at.a")].alias("feature_a"), names[F.col("at.b")].alias("feature_b"), "corr")


def scatter_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """All points with both coordinates."""
    return df.select(F.col(x).alias("x"), F.col(y).alias("y")).where("x is not null and y is not null")


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Point counts on a bins x bins grid: a plot whose size does not grow with the data."""
    points = scatter_points(df, x, y).select(F.col("x").cast("double"), F.col("y").cast("double"))
    box = points.agg(*[f(c).alias(f"{n}{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))])

    def bound(name: str) -> Column:
        return box.select(name).scalar()

    def cell(c: str) -> Column:
        width = F.try_divide(F.col(c) - bound(f"lo{c}"), bound(f"hi{c}") - bound(f"lo{c}"))
        return F.least(F.coalesce(F.floor(width * bins), F.lit(0)), F.lit(bins - 1)).cast("int")

    return points.groupBy(cell("x").alias("x_bin"), cell("y").alias("y_bin")).agg(F.count("*").alias("n"))


def mean_by_year(frame: DataFrame, company: str, columns: Sequence[str] = ("budget", "revenue")) -> DataFrame:
    """Mean money columns per release year for one company's movies."""
    return company_rows(frame, company).where("release_year is not null").groupBy("release_year").agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns])
