"""Chained regression imputation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marquee.operators.features import FittedStep
from marquee.operators.ranking import exact_quantiles
from marquee.session import materialize


def bayesian_ridge(gram: np.ndarray, xy: np.ndarray, yy: float, n: float, rounds: int = 300) -> np.ndarray:
    """Weights of a Bayesian ridge regression from centred moments.

    Noise and weight precisions are re-estimated by evidence maximisation; the sums are all it needs,
    so its cost depends on the number of columns only.
    """
    values, vectors = np.linalg.eigh(gram)
    values = np.clip(values, 0.0, None)
    projected = vectors.T @ xy
    noise, prior = n / max(yy, 1e-12), 1.0
    weights = np.zeros_like(xy)
    for _ in range(rounds):
        previous = weights
        weights = vectors @ (projected / (values + prior / noise))
        residual = max(yy - 2 * weights @ xy + weights @ gram @ weights, 1e-12)
        effective = float(np.sum(noise * values / (prior + noise * values)))
        prior = (effective + 2e-6) / (float(weights @ weights) + 2e-6)
        noise = max(n - effective + 2e-6, 1e-6) / (residual + 2e-6)
        if np.sum(np.abs(weights - previous)) < 1e-6:
            break
    return weights


MAX_PATTERNS = 20_000


class ChainedImputer(Estimator):
    """Fill each incomplete numeric column from a regression on all the others, in rounds.

    Columns go from fewest to most missing cells, starting from medians. Rows with the same set of
    gaps are filled by the same affine map, so a round only needs the moments of each gap pattern:
    one aggregate over the data, grouped by pattern, serves every regression of every round, and the
    rounds themselves are small matrix products on the driver. Beyond ``max_patterns`` patterns each
    regression is an aggregate of its own and each round is written to the shared folder.

    Stops early once the filled cells move by less than ``tolerance`` standard deviations (root mean
    square).
    """

    def __init__(self, columns: Sequence[str], rounds: int = 10, tolerance: float = 1e-3,
                 max_patterns: int = MAX_PATTERNS):
        super().__init__()
        self.columns, self.rounds, self.tolerance, self.max_patterns = list(columns), rounds, tolerance, max_patterns

    @staticmethod
    def _cell(c: str) -> Column:
        return F.nanvl(F.col(c).cast("double"), F.lit(None))

    def _standardized(self, df: DataFrame, stats: dict, median: dict) -> DataFrame:
        """Scaled cells with medians in the gaps, next to flags of what was missing."""
        values, gaps = [], []
        for c, (mean, std) in stats.items():
            values.append(((F.coalesce(self._cell(c), F.lit(median[c])) - mean) / std).alias(f"v_{c}"))
            gaps.append(self._cell(c).isNull().alias(f"m_{c}"))
        return df.select(*values, *gaps)

    @staticmethod
    def _prediction(model: dict) -> Column:
        total = F.lit(float(model["intercept"]))
        for c, w in model["weights"].items():
            total = total + F.lit(float(w)) * F.col(f"v_{c}")
        return total

    @staticmethod
    def _regression(moments: np.ndarray, target: str, names: list[str]) -> dict:
        """Model of one column on the others, from the summed products of (1, columns)."""
        n = moments[0, 0]
        mean = moments[0, 1:] / n
        cross = moments[1:, 1:] - n * np.outer(mean, mean)
        at = names.index(target)
        rest = [i for i in range(len(names)) if i != at]
        weights = bayesian_ridge(cross[np.ix_(rest, rest)], cross[rest, at], float(cross[at, at]), float(n))
        return {"intercept": float(mean[at] - weights @ mean[rest]),
                "weights": {names[i]: float(w) for i, w in zip(rest, weights)}}

    @staticmethod
    def _moment_columns(names: list[str]) -> list[Column]:
        """Summed products of (1, columns), upper triangle row by row."""
        values = ["1D"] + [f"`v_{c}`" for c in names]
        pairs = [(i, j) for i in range(len(values)) for j in range(i, len(values))]
        return [F.expr(f"sum({values[i]} * {values[j]}) AS p{i}_{j}") for i, j in pairs]

    @staticmethod
    def _square(flat: Sequence[float], k: int) -> np.ndarray:
        out = np.zeros((k + 1, k + 1))
        out[np.triu_indices(k + 1)] = flat
        return np.triu(out) + np.triu(out, 1).T

    def _fit_on_patterns(self, rows: list, names: list[str], gaps: list[str]) -> list:
        """All rounds from per-pattern moments. A pattern's map takes a started row to its current fill."""
        k = len(names)
        missing = np.array([[bool(r["pattern"] >> i & 1) for i in range(len(gaps))] for r in rows])
        start = np.stack([self._square(r[1:], k) for r in rows])
        maps = np.tile(np.eye(k + 1), (len(rows), 1, 1))
        history = []
        for _ in range(self.rounds):
            steps, moved = [], 0.0
            for g, target in enumerate(gaps):
                known = maps[~missing[:, g]]
                moments = (known @ start[~missing[:, g]] @ known.transpose(0, 2, 1)).sum(axis=0)
                model = self._regression(moments, target, names)
                steps.append((target, model))
                line = np.array([model["intercept"]] + [model["weights"].get(c, 0.0) for c in names])
                at, hit = names.index(target) + 1, missing[:, g]
                fresh = line @ maps[hit]
                change = fresh - maps[hit][:, at]
                moved += float(np.einsum("pi,pij,pj->", change, start[hit], change))
                maps[hit, at] = fresh
            history.append(steps)
            cells = float((missing.sum(axis=1) * start[:, 0, 0]).sum())
            if np.sqrt(max(moved, 0.0) / cells) < self.tolerance:
                break
        return history

    def _fit_by_passes(self, frame: DataFrame, names: list[str], gaps: list[str]) -> list:
        """All rounds with one aggregate per regression, for frames with very many gap patterns."""
        history = []
        for _ in range(self.rounds):
            steps, moved = [], frame.select("*", *[F.col(f"v_{c}").alias(f"o_{c}") for c in gaps])
            for target in gaps:
                sums = moved.where(~F.col(f"m_{target}")).agg(*self._moment_columns(names)).first()
                model = self._regression(self._square(sums, len(names)), target, names)
                steps.append((target, model))
                moved = moved.withColumn(
                    f"v_{target}", F.when(F.col(f"m_{target}"), self._prediction(model)).otherwise(F.col(f"v_{target}")))
            history.append(steps)
            # The values before the round are written too, so the move needs no second evaluation.
            frame = materialize(moved, "impute")
            squares = sum(F.pow(F.col(f"v_{c}") - F.col(f"o_{c}"), 2) for c in gaps)
            cells = sum(F.col(f"m_{c}").cast("int") for c in gaps)
            move = frame.agg(F.sqrt(F.sum(squares) / F.sum(cells))).first()[0]
            frame = frame.drop(*[f"o_{c}" for c in gaps])
            if move < self.tolerance:
                break
        return history

    def _fit(self, dataset: DataFrame) -> FittedStep:
        names = self.columns
        row = dataset.agg(*[
            f(self._cell(c)).alias(f"{n}_{c}") for c in names
            for n, f in (("n", F.count), ("mean", F.avg), ("std", F.stddev_pop))], F.count("*").alias("rows")).first()
        empty = [c for c in names if row[f"n_{c}"] == 0]
        if empty:
            raise ValueError(f"columns without any value: {empty}")
        stats = {c: (row[f"mean_{c}"], row[f"std_{c}"] or 1.0) for c in names}
        gaps = sorted((c for c in names if row[f"n_{c}"] < row["rows"]), key=lambda c: (-row[f"n_{c}"], c))
        medians = {r["feature"]: r["quantiles"][0] for r in exact_quantiles(dataset, names, [0.5]).collect()}

        history: list[list[tuple[str, dict]]] = []
        if gaps:
            frame = self._standardized(dataset, stats, medians)
            bits = sum(F.shiftleft(F.col(f"m_{c}").cast("long"), i) for i, c in enumerate(gaps))
            patterns = frame.groupBy(bits.alias("pattern")).agg(*self._moment_columns(names))
            rows = patterns.limit(self.max_patterns + 1).collect() if len(gaps) < 63 else None
            if rows is not None and len(rows) <= self.max_patterns:
                history = self._fit_on_patterns(rows, names, gaps)
            else:
                history = self._fit_by_passes(materialize(frame, "impute"), names, gaps)

        return FittedStep(_filler(names, stats, medians, history), history=history, stats=stats, medians=medians)


def _filler(names: list[str], stats: dict, medians: dict, history: list) -> Callable[[DataFrame], DataFrame]:
    """Replay of the fitted rounds on any frame.

    One Arrow pass: as column expressions the rounds would nest into one another and the plan would
    grow with rounds x columns. Columns outside ``names`` pass through untouched.
    """
    mean = np.array([stats[c][0] for c in names])
    std = np.array([stats[c][1] for c in names])
    start = np.array([medians[c] for c in names])
    steps = []
    for rounds in history:
        for target, model in rounds:
            weights = np.array([model["weights"].get(c, 0.0) for c in names])
            steps.append((names.index(target), weights, float(model["intercept"])))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [pc.cast(batch.column(c), pa.float64()).to_numpy(zero_copy_only=False) for c in names]
            raw = np.column_stack(cells)
            gap = np.isnan(raw)
            scaled = (np.where(gap, start, raw) - mean) / std
            for at, weights, intercept in steps:
                rows = gap[:, at]
                scaled[rows, at] = scaled[rows] @ weights + intercept
            filled = np.where(gap, scaled * std + mean, raw)
            columns = [
                pa.array(filled[:, names.index(n)]) if n in names else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    def apply(df: DataFrame) -> DataFrame:
        schema = T.StructType([T.StructField(f.name, T.DoubleType()) if f.name in names else f for f in df.schema])
        return df.mapInArrow(fill, schema)

    return apply
