"""Stored per-period KLL sketches: any range profiled without rereading, and exactly with brackets."""

import numpy as np
import pytest

from marquee.operators import ranking
from marquee.session import materialize


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(6)
    n = 6000
    period = rng.integers(0, 12, n)
    a = np.where(rng.random(n) < 0.35, 7.0, rng.lognormal(2, 1, n))      # a third of the rows share one value
    b = rng.normal(0, 1, n)
    b[::97] = np.nan
    rows = [(int(p), float(x), None if np.isnan(y) else float(y)) for p, x, y in zip(period, a, b)]
    df = spark.createDataFrame(rows, "period int, a double, b double")
    return df, period, a, b


def numpy_quantile(values, p):
    return float(np.quantile(values, p, method="linear"))


def test_exact_range_equals_numpy(spark, frame):
    df, period, a, b = frame
    sketches = materialize(ranking.period_sketches(df, ["a", "b"], "period"), "sketches")
    probs = [0.0, 0.1, 0.35, 0.5, 0.9, 1.0]
    for start, end in ((None, None), (3, 8), (5, 5)):
        inside = np.ones(len(period), bool) if start is None else (period >= start) & (period <= end)
        got = {r.feature: r for r in ranking.range_profile(df, ["a", "b"], "period", sketches, probs, start, end).collect()}
        for name, col in (("a", a), ("b", b)):
            values = col[inside & ~np.isnan(col)]
            r = got[name]
            assert r["count"] == len(values) and r["min"] == values.min() and r["max"] == values.max()
            assert abs(r["mean"] - values.mean()) < 1e-9 * max(1, abs(values.mean())) + 1e-12
            assert abs(r["std"] - values.std(ddof=1)) < 1e-7 * values.std(ddof=1)
            assert r["quantiles"] == pytest.approx([numpy_quantile(values, p) for p in probs], rel=1e-12, abs=1e-12)


def test_sketch_alone_within_rank_error(spark, frame):
    df, period, a, _ = frame
    sketches = ranking.period_sketches(df, ["a"], "period")
    r = ranking.sketched_profile(sketches, [0.25, 0.5, 0.75], 2, 9).collect()[0]
    values = np.sort(a[(period >= 2) & (period <= 9)])
    assert r["count"] == len(values)
    for p, q in zip([0.25, 0.5, 0.75], r["quantiles"]):
        rank = np.searchsorted(values, q, "right") / len(values)
        assert abs(rank - p) <= ranking.KLL_SLACK or q == 7.0


def test_empty_range(spark, frame):
    df, *_ = frame
    sketches = ranking.period_sketches(df, ["a"], "period")
    assert ranking.range_profile(df, ["a"], "period", sketches, [0.5], 100, 200).count() == 0
