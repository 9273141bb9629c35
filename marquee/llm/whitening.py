"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance is never formed. Every product with it is one distributed pass over the stored, centred fit list
(``x - S/n`` for each distinct quantised vector), which sums ``Y^T (Y W)`` per partition; only ``d x k`` numbers
per partition come back. On the driver stay a search basis of at most a few dozen vectors of length ``d``, the
locked eigenvectors and small projected matrices, all bounded by the dimension, never by the number of rows.

One outer step: Rayleigh-Ritz on the search basis, locking of the leading Ritz pairs whose residual norm is below
``TOLERANCE`` times the largest eigenvalue, then for every wanted pair not yet locked the correction equation
``(I - ZZ^T)(V - theta I)(I - ZZ^T) t = -r`` (``Z`` = locked vectors and the Ritz vector) solved approximately by
MINRES, all pairs in lockstep so that each inner step is one pass. The corrections, made orthogonal, widen the basis.

Defined cases: rows whose vector is null, holds a null, NaN or infinite entry, or is shorter than the longest
valid vector are dropped. An empty table, or one whose valid vectors are empty, gives no rows. Components are
numbered by falling eigenvalue; components with a zero eigenvalue (rank below 16, e.g. one distinct vector) are
not returned, as their whitened value is undefined. Ties among eigenvalues give some orthonormal basis of their
space. Repeated vectors count once in the fit list and each of their rows is returned. Columns other than id and
vector are not read, so extra or clashing columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm.registry import query
from marquee.session import materialize

# Fixed values of the contract: x = floor(64 * c) + 1000000, up to 16 components.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Residual norm at which a pair counts as converged, relative to the largest eigenvalue.
TOLERANCE = 1e-13
#: MINRES steps per correction equation, and outer steps before giving up with an error.
INNER_STEPS, MAX_OUTER = 10, 200


def quantised(emb: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, x) of every row with a whole, finite vector of the full dimension; x as array<bigint>."""
    valid = F.expr(f"`{vec_col}` IS NOT NULL AND forall(`{vec_col}`, c -> c IS NOT NULL AND NOT isnan(c) AND abs(CAST(c AS DOUBLE)) < double('Infinity'))")
    rows = emb.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where(valid)
    x = F.transform("v", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + F.lit(SHIFT))
    return rows.select("id", x.alias("x"), F.size("v").alias("d"))


def product_pass(fit: DataFrame, d: int, n: int) -> Callable[[np.ndarray], np.ndarray]:
    """``W -> V W`` for the covariance V of the centred fit list ``fit`` (column ``y``), one Spark job a call."""

    def apply(w: np.ndarray) -> np.ndarray:
        w = np.ascontiguousarray(w, dtype=np.float64)
        k = w.shape[1]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = np.zeros((d, k))
            for b in batches:
                if b.num_rows:
                    y = pc.list_flatten(b.column(0)).to_numpy(zero_copy_only=False).reshape(-1, d)
                    acc += y.T @ (y @ w)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * k, dtype=np.int32)), pa.array(acc.ravel())], ["i", "v"])

        parts = fit.select("y").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(d * k)
        for r in parts:
            out[r["i"]] = r["v"]
        return out.reshape(d, k) / n

    return apply


def _orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns of ``t`` made orthogonal to ``against`` and to each other (twice, for rounding); tiny ones dropped."""
    for _ in range(2):
        for a in against:
            if a.shape[1]:
                t = t - a @ (a.T @ t)
    kept = []
    for j in range(t.shape[1]):
        v = t[:, j].copy()
        size = np.linalg.norm(v)
        for _ in range(2):
            for u in kept:
                v -= u * (u @ v)
        if size > 0 and np.linalg.norm(v) > 1e-10 * size:
            kept.append(v / np.linalg.norm(v))
    return np.column_stack(kept) if kept else np.zeros((t.shape[0], 0))


def minres(op: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of ``op(x) = b`` for every column of ``b`` (symmetric ``op``), all columns in lockstep."""
    x = np.zeros_like(b)
    beta1 = np.linalg.norm(b, axis=0)
    live = beta1 > 0
    if not live.any():
        return x
    one = np.ones_like(beta1)
    r1 = b.copy()
    r2 = b.copy()
    y = b.copy()
    oldb = np.zeros_like(beta1)
    beta = beta1.copy()
    dbar = np.zeros_like(beta1)
    epsln = np.zeros_like(beta1)
    phibar = beta1.copy()
    cs, sn = -one, np.zeros_like(beta1)
    w, w2 = np.zeros_like(b), np.zeros_like(b)
    for step in range(steps):
        live &= beta > 1e-300
        if not live.any():
            break
        v = y / np.where(live, beta, 1.0)
        y = op(v)
        if step:
            y = y - (beta / np.where(oldb > 0, oldb, 1.0)) * r1
        alfa = np.sum(v * y, axis=0)
        y = y - (alfa / np.where(live, beta, 1.0)) * r2
        r1, r2 = r2, y
        oldb, beta = beta, np.linalg.norm(y, axis=0)
        oldeps = epsln
        delta = cs * dbar + sn * alfa
        gbar = sn * dbar - cs * alfa
        epsln = sn * beta
        dbar = -cs * beta
        gamma = np.maximum(np.hypot(gbar, beta), np.finfo(float).tiny)
        cs, sn = gbar / gamma, beta / gamma
        phi = cs * phibar
        phibar = sn * phibar
        w1, w2 = w2, w
        w = (v - oldeps * w1 - delta * w2) / gamma
        x = x + np.where(live, phi, 0.0) * w
    return x


def jacobi_davidson(apply: Callable[[np.ndarray], np.ndarray], d: int, want: int, seed: int = 0,
                    tolerance: float = TOLERANCE, inner: int = INNER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenpairs (values falling, vectors as columns) of the symmetric map ``apply``."""
    want = min(want, d)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((d, 0)), []
    block = min(d, want + 4)
    basis = _orthonormal(rng.standard_normal((d, block)))
    image = apply(basis)
    scale = 0.0
    for _ in range(MAX_OUTER):
        h = basis.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-theta, kind="stable")
        theta, y = theta[order], y[:, order]
        ritz, ritz_image = basis @ y, image @ y
        residual = ritz_image - ritz * theta
        norms = np.linalg.norm(residual, axis=0)
        scale = max(scale, float(theta[0]) if len(theta) else 0.0, *values)
        floor = tolerance * scale if scale > 0 else np.finfo(float).tiny
        done = 0
        while done < len(theta) and len(values) + done < want and norms[done] <= floor:
            done += 1
        if done:
            locked = np.column_stack([locked, ritz[:, :done]])
            values += [float(t) for t in theta[:done]]
            ritz, ritz_image, theta, residual = ritz[:, done:], ritz_image[:, done:], theta[done:], residual[:, done:]
        if len(values) >= want:
            break
        room = d - locked.shape[1]
        keep = min(ritz.shape[1], max(want - len(values) + 4, 1), room)
        if ritz.shape[1] > 3 * block:
            ritz, ritz_image, theta, residual = ritz[:, :keep], ritz_image[:, :keep], theta[:keep], residual[:, :keep]
        basis, image = ritz, ritz_image
        wanted = min(want - len(values), ritz.shape[1], block)
        if wanted and basis.shape[1] < room:
            u, th = ritz[:, :wanted], theta[:wanted]

            def project(v: np.ndarray, u: np.ndarray = u) -> np.ndarray:
                if locked.shape[1]:
                    v = v - locked @ (locked.T @ v)
                return v - u * np.sum(u * v, axis=0)

            def op(v: np.ndarray, th: np.ndarray = th) -> np.ndarray:
                p = project(v)
                return project(apply(p) - p * th)

            t = _orthonormal(minres(op, -project(residual[:, :wanted]), inner), locked, basis)
            if not t.shape[1]:
                t = _orthonormal(rng.standard_normal((d, wanted)), locked, basis)
            t = t[:, :room - basis.shape[1]]
            if t.shape[1]:
                basis, image = np.column_stack([basis, t]), np.column_stack([image, apply(t)])
        elif basis.shape[1] == 0:
            basis = _orthonormal(rng.standard_normal((d, min(block, room))), locked)
            image = apply(basis)
    else:
        raise RuntimeError(f"Jacobi-Davidson did not converge in {MAX_OUTER} steps: {len(values)} of {want} pairs")
    return np.array(values), locked


def whiten(emb: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, label: str = "whiten") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every valid row and component."""
    spark = emb.sparkSession
    rows = quantised(emb, id_col, vec_col)
    d = rows.agg(F.max("d")).first()[0]
    schema = f"{id_col} {emb.schema[id_col].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not d:
        return spark.createDataFrame([], schema)
    rows = materialize(rows.where(F.col("d") == d).select("id", "x"), label)
    fit = rows.select("x").distinct()
    sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s"), F.count("*").alias("n")).collect()
    n = sums[0]["n"] if sums else 0
    s = [0] * d
    for r in sums:
        s[r["i"]] = int(r["s"])
    s_lit = F.array(*[F.lit(v).cast("long") for v in s])
    gap = F.transform("x", lambda v, i: F.lit(n).cast("long") * v - s_lit[i])
    centred = F.transform(gap, lambda g: g.cast("double") / F.lit(float(n)))
    deviation = F.aggregate(F.transform(gap, lambda g: g.cast("decimal(38,0)") * g.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"), lambda a, b: a + b)
    fit = materialize(fit.select(centred.alias("y"), deviation.alias("dev")), label)
    trace = float(fit.agg(F.sum("dev")).first()[0]) / float(n) ** 3

    apply = product_pass(fit, d, n)
    values, vectors = jacobi_davidson(apply, d, min(components, d))
    positive = values > TOLERANCE * max(values.max(initial=0.0), 0.0) if len(values) else np.zeros(0, bool)
    values, vectors = values[positive], vectors[:, positive]
    if not len(values):
        return spark.createDataFrame([], schema)
    scaled = vectors / np.sqrt(values)
    covariance = scaled.T @ apply(vectors) / np.sqrt(values)
    identity_error = float(np.abs(covariance - np.eye(len(values))).max())

    weights = F.array(*[F.array(*[F.lit(float(v)) for v in scaled[:, c]]) for c in range(len(values))])
    explained = F.array(*[F.lit(float(e / trace)) for e in values])
    whitened = F.transform(weights, lambda u: F.aggregate(F.zip_with(centred, u, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v))
    out = rows.select(F.col("id").alias(id_col), deviation.cast("long").alias("deviation"), F.posexplode(whitened).alias("c", "whitened"))
    return out.select(id_col, (F.col("c") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      explained[F.col("c")].alias("explained"), F.lit(identity_error).alias("identity_error"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened projections of every valid embedding on the 16 leading components of the distinct vectors."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
