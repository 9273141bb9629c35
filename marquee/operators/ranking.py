"""Global positions and exact order statistics without a single-task window.

Rows are range-partitioned on a total order and written once to the shared folder. A row's global
position is its position inside its partition plus the sizes of the partitions before it; the
partition sizes are the only thing aggregated, one row per partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.session import materialize

_ROW_BITS = (1 << 33) - 1


def _placed(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Range-partitioned, sorted, written copy of ``df`` with partition and in-partition position."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.monotonically_increasing_id()
    sorted_rows = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return materialize(
        sorted_rows.select("*", F.shiftright(row, 33).cast("int").alias("__part"),
                           row.bitwiseAND(F.lit(_ROW_BITS)).alias("__pos")),
        label,
    )


def with_dense_index(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Add a gap-free index following ``order``; the order must be total (end it with a unique key)."""
    placed = _placed(df, order, "index")
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__size"))
    # One row per partition: the window and the broadcast are bounded by the partition count.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__pos") + F.lit(start))
        .drop("__part", "__pos", "__offset")
    )


def melt_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (feature, value) for the non-missing cells of ``columns``; NaN counts as missing."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value"))
        for c in columns
    ])
    return df.select(F.inline(cells)).where("value is not null")


SKETCH_ACCURACY = 10_000
_PROFILE = "feature string, count long, mean double, std double, quantiles array<double>"


def value_profile(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                  exact_below: int = 10 * SKETCH_ACCURACY) -> DataFrame:
    """Per column: count, mean, sample deviation and exact, linearly interpolated quantiles.

    A first pass sketches each column and brackets every quantile. The second counts single values
    only inside the brackets; all values between two brackets count as one, which leaves the ranks
    unchanged but next to nothing to shuffle. Should a quantile fall outside its bracket, the second
    pass is repeated without brackets, as it is for columns of up to ``exact_below`` values. Columns
    without values are left out; the result has one row per column.
    """
    values = melt_numeric(df, columns)
    slack = 2 / SKETCH_ACCURACY
    edges = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-slack, slack)]
    sketch = values.groupBy("feature").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.percentile_approx("value", edges, SKETCH_ACCURACY).alias("edges")).collect()
    if not sketch:
        return df.sparkSession.createDataFrame([], _PROFILE)
    brackets = {r["feature"]: _brackets(r["edges"], probs, slack) for r in sketch if r["n"] > exact_below}
    found = _at_ranks(values, probs, brackets)
    if any(r["outside"] for r in found.values()):
        found = _at_ranks(values, probs, {})
    rows = []
    for r in sketch:
        quantiles = []
        for i, p in enumerate(probs):
            low, high, place = found[r["feature"]][f"lo{i}"], found[r["feature"]][f"hi{i}"], p * (r["n"] - 1)
            quantiles.append(low + (high - low) * (place - math.floor(place)))
        rows.append((r["feature"], r["n"], r["mean"], r["std"], quantiles))
    return df.sparkSession.createDataFrame(rows, _PROFILE)


def _brackets(edges: Sequence[float], probs: Sequence[float], slack: float) -> list[tuple[float, float]]:
    """Disjoint value ranges, in order, around the sketched quantiles."""
    ranges = sorted(
        (-math.inf if p <= slack else edges[2 * i], math.inf if p >= 1 - slack else edges[2 * i + 1])
        for i, p in enumerate(probs))
    merged = [ranges[0]]
    for low, high in ranges[1:]:
        if low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def _snapped(brackets: dict[str, list[tuple[float, float]]]) -> Column:
    """struct(value, side): the value itself (side 0), or the bracket end next to it."""
    def pair(value: str, side: int) -> str:
        return f"named_struct('value', {value}, 'side', {side})"

    def number(x: float) -> str:
        return f"CAST('{x!r}' AS DOUBLE)"

    itself, cases = pair("value", 0), []
    for feature, ranges in brackets.items():
        steps = [] if ranges[0][0] == -math.inf else [f"WHEN value < {number(ranges[0][0])} THEN {pair(number(ranges[0][0]), -1)}"]
        for i, (low, high) in enumerate(ranges):
            if i:
                steps.append(f"WHEN value < {number(low)} THEN {pair(number(ranges[i - 1][1]), 1)}")
            steps.append(f"WHEN {'true' if high == math.inf else 'value <= ' + number(high)} THEN {itself}")
        steps.append(f"ELSE {pair(number(ranges[-1][1]), 1)}" if ranges[-1][1] != math.inf else f"ELSE {itself}")
        quoted = feature.replace("\\", "\\\\").replace("'", "\\'")
        cases.append(f"WHEN feature = '{quoted}' THEN CASE {' '.join(steps)} END")
    return F.expr(f"CASE {' '.join(cases)} ELSE {itself} END" if cases else itself)


def _at_ranks(values: DataFrame, probs: Sequence[float], brackets: dict) -> dict[str, dict]:
    """The values at both ranks next to each quantile, by column, and whether one was not a single value."""
    snapped = values.select("feature", _snapped(brackets).alias("at")).selectExpr(
        "feature", "at.value", "at.side")
    # Equal values are counted before the shuffle: one that fills a third of a column is one row.
    counts = snapped.groupBy("feature", "value", "side").agg(F.count("*").alias("n"))
    placed = _placed(counts, [F.col("feature"), F.col("value"), F.col("side")], "quantiles")
    # A partition holds a bounded range of values, so this window splits evenly.
    running = Window.partitionBy("__part", "feature").orderBy("value", "side").rowsBetween(Window.unboundedPreceding, 0)
    # One row per partition and column from here to the broadcast.
    sizes = placed.groupBy("feature", "__part").agg(F.sum("n").alias("__size"))
    whole = Window.partitionBy("feature")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "feature", "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"),
        F.sum("__size").over(whole).alias("__total"))
    spans = (
        placed.withColumn("__end", F.sum("n").over(running))
        .join(F.broadcast(offsets), ["feature", "__part"])
        .withColumn("__end", F.col("__end") + F.col("__before"))
        .withColumn("__start", F.col("__end") - F.col("n"))
    )
    aggregates, hits = [], []
    for i, p in enumerate(probs):
        for name, near in (("lo", F.floor), ("hi", F.ceil)):
            rank = near(F.lit(float(p)) * (F.col("__total") - 1))
            hit = (F.col("__start") <= rank) & (rank < F.col("__end"))
            aggregates.append(F.max(F.when(hit, F.col("value"))).alias(f"{name}{i}"))
            hits.append(hit)
    outside = F.max((F.col("side") != 0) & reduce(lambda a, b: a | b, hits)).alias("outside")
    return {r["feature"]: r.asDict() for r in spans.groupBy("feature").agg(outside, *aggregates).collect()}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(feature, quantiles): one array entry per probability."""
    return value_profile(df, columns, probs).select("feature", "quantiles")


def hash_column(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def smallest_by_hash(df: DataFrame, keys: Sequence[str], share: float, seed: int) -> Column:
    """Predicate that holds for exactly ceil(rows * share) rows, chosen by key hash.

    The cut is found by narrowing 12 hash bits per pass; each pass aggregates to at most 4096 counts
    and nothing is shuffled but those. ``keys`` must be unique.
    """
    h = hash_column(keys, seed)
    bits = 12
    low, width = -(1 << 63), 64
    hashes = df.select(h.alias("h"), *keys)
    wanted = None
    while True:
        span = hashes if width == 64 else hashes.where(F.col("h").between(low, low + (1 << width) - 1))
        step = max(width - bits, 0)
        # Shifting before subtracting keeps the bucket number inside 64 bits.
        bucket = F.shiftright(F.col("h"), step) - F.lit(low >> step)
        rows = span.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).orderBy("b").collect()
        if wanted is None:
            total = sum(r["n"] for r in rows)
            # The product is rounded first so that 0.15 * 1000 stays 150.
            wanted = math.ceil(round(total * share, 9))
            if wanted <= 0:
                return F.lit(False)
            if wanted >= total:
                return F.lit(True)
        for r in rows:
            if wanted <= r["n"]:
                break
            wanted -= r["n"]
        low, width = low + (r["b"] << step), step
        if r["n"] <= 4096 or width == 0:
            break
    # At most 4096 rows share the last bucket unless keys repeat.
    cut = (
        hashes.where(F.col("h").between(low, low + (1 << width) - 1))
        .orderBy("h", *keys).limit(wanted).orderBy(F.struct("h", *keys).desc()).first()
    )
    tie = F.struct(*[F.col(k) for k in keys]) <= F.struct(
        *[F.lit(cut[k]).cast(df.schema[k].dataType).alias(k) for k in keys]
    )
    return (h < F.lit(cut["h"])) | ((h == F.lit(cut["h"])) & tie)


#: Size of the stored quantile sketches, and the rank slack put around each sketched quantile (about twice the
#: normalised rank error of a KLL sketch of this size, for any number of merged sketches).
KLL_K, KLL_SLACK = 200, 0.04
_RANGE = "feature string, count long, mean double, std double, min double, max double, quantiles array<double>"


def _period_values(df: DataFrame, columns: Sequence[str], period: str) -> DataFrame:
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value")) for c in columns])
    return df.select(F.col(period).alias("period"), F.inline(cells)).where("value is not null")


def period_sketches(df: DataFrame, columns: Sequence[str], period: str) -> DataFrame:
    """(period, feature, n, total, squares, low, high, sketch): per period and column a mergeable KLL sketch and sums.

    Stored once, it answers the profile of any range of periods without reading the rows again.
    """
    value = F.col("value")
    return _period_values(df, columns, period).groupBy("period", "feature").agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.sum(value * value).alias("squares"), F.min(value).alias("low"),
        F.max(value).alias("high"), F.kll_sketch_agg_double(value, KLL_K).alias("sketch"))


def _merged(sketches: DataFrame, start: Any = None, end: Any = None) -> DataFrame:
    chosen = sketches
    if start is not None:
        chosen = chosen.where(F.col("period") >= F.lit(start))
    if end is not None:
        chosen = chosen.where(F.col("period") <= F.lit(end))
    n = F.sum("n")
    return chosen.groupBy("feature").agg(
        n.alias("n"), (F.sum("total") / n).alias("mean"),
        F.sqrt(F.try_divide(F.sum("squares") - F.sum("total") * F.sum("total") / n, n - 1)).alias("std"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch", KLL_K).alias("sketch"))


def sketched_profile(sketches: DataFrame, probs: Sequence[float], start: Any = None, end: Any = None) -> DataFrame:
    """Count, mean, deviation, extremes and quantiles of the periods in [start, end], from stored sketches alone.

    The quantiles are the sketch's, within its rank error; ``range_profile`` makes them exact.
    """
    merged = _merged(sketches, start, end)
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs])
    return merged.select("feature", F.col("n").alias("count"), "mean", "std", F.col("low").alias("min"), F.col("high").alias("max"),
                         quantiles.alias("quantiles"))


def range_profile(df: DataFrame, columns: Sequence[str], period: str, sketches: DataFrame, probs: Sequence[float],
                  start: Any = None, end: Any = None) -> DataFrame:
    """As ``sketched_profile`` with exact, linearly interpolated quantiles.

    The merged sketch brackets each quantile by ``KLL_SLACK`` of rank on both sides; only the values of the range
    inside the brackets are counted one by one, the rest as one per side. A quantile outside its bracket (the sketch
    erred beyond its slack) repeats the count without brackets, so the result is exact in every case.
    """
    spark = df.sparkSession
    edges = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-KLL_SLACK, KLL_SLACK)]
    merged = _merged(sketches, start, end).select(
        "feature", "n", "mean", "std", "low", "high",
        F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(e)) for e in edges]).alias("edges")).collect()
    if not merged:
        return spark.createDataFrame([], _RANGE)
    rows = df
    if start is not None:
        rows = rows.where(F.col(period) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(period) <= F.lit(end))
    values = _period_values(rows, columns, period).drop("period")
    brackets = {r["feature"]: _brackets(r["edges"], probs, KLL_SLACK) for r in merged}
    found = _at_ranks(values, probs, brackets)
    if any(r["outside"] for r in found.values()):
        found = _at_ranks(values, probs, {})
    out = []
    for r in merged:
        quantiles = []
        for i, p in enumerate(probs):
            low, high, place = found[r["feature"]][f"lo{i}"], found[r["feature"]][f"hi{i}"], p * (r["n"] - 1)
            quantiles.append(low + (high - low) * (place - math.floor(place)))
        out.append((r["feature"], r["n"], r["mean"], r["std"], r["low"], r["high"], quantiles))
    return spark.createDataFrame(out, _RANGE)
