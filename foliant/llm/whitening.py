"""Embedding whitening: leading principal components by a block Jacobi-Davidson method.

The covariance matrix is never formed. Its product with a block of vectors is one
Spark job: every task centres its rows exactly (``n * x - S`` in whole numbers), multiplies
them with the block and back, and the partial results (dimension x block numbers
a task) are summed by Spark. The driver holds vectors of the dimension only:

1. Rayleigh-Ritz on the search space gives the wanted pairs and their residuals.
2. For each pair that has not converged, inner MINRES steps solve the projected
   correction equation ``(I - QQ')(A - theta I)(I - QQ') t = -r``; all pairs step at once,
   so that one product serves them all.
3. The corrections extend the search space (thick restart when it is full). Pairs
   whose residual reaches double precision are locked, in order, and the search space is
   kept orthogonal to them.

The locked pairs are taken to a last Rayleigh-Ritz of fresh products. Vectors are stored
once as blocks of whole numbers, which all products read.

Defined results: rows whose vector is null, or holds null or non-finite entries, are left
out; so are rows of another length than most have (ties: the longest), and empty
vectors. Entries beyond 2^40 count as 2^40 (either sign). Components whose eigenvalue
is zero up to rounding have no whitened value and are not returned, so equal vectors
give an empty result, as do empty tables. ``deviation`` beyond a long is null. Repeated
rows and ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import materialize, release

SCALE, SHIFT = 1024, 100_000
#: Rows of a stored block (fewer for long vectors: about a megabyte).
BLOCK_BYTES = 1 << 20
#: Inner MINRES steps of one correction, and outer steps before giving up.
INNER, OUTER = 6, 200
#: Residuals, relative to the largest eigenvalue, that count as double precision.
TOLERANCE = 2e-14


# -- stored blocks ----------------------------------------------------------------

def whole_numbers(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: entries as whole numbers, without the rows that have no finite vector."""
    most = 2.0**40
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    cell = lambda c: F.floor(F.greatest(F.least(c.cast("double"), F.lit(most)), F.lit(-most)) * SCALE).cast("bigint") + SHIFT
    return vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite) \
        .select("vec_id", F.transform("embedding", cell).alias("x"))


def _flat(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _pack(d: int):
    def run(batches):
        rows = max(1, BLOCK_BYTES // (8 * d))
        for batch in batches:
            if batch.num_rows:
                x = _flat(batch.column("x"), d) - SHIFT
                ids = batch.column("vec_id")
                for at in range(0, len(x), rows):
                    part = x[at: at + rows]
                    small = len(part) and max(part.max(), -part.min()) < 2**31
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[at: at + rows].to_pylist()], pa.list_(pa.int64())),
                         pa.array([part.astype(np.int32 if small else np.int64).tobytes()], pa.binary()), pa.array([4 if small else 8], pa.int32())],
                        ["ids", "x", "width"])

    return run


def _blocks(batches, d: int, more=()):
    """Whole numbers of each stored block, and further columns."""
    for batch in batches:
        for at, (x, width) in enumerate(zip(batch.column("x"), batch.column("width").to_pylist())):
            kind = np.int32 if width == 4 else np.int64
            rows = np.frombuffer(x.as_buffer(), kind).reshape(-1, d).astype(np.int64)
            yield (rows + SHIFT, *[batch.column(c)[at] for c in more])


def _summed(blocks: DataFrame, partial, kind: str) -> np.ndarray:
    """Sum over all tasks of ``partial(batches)``, a flat array a task; summed by Spark."""
    def run(batches):
        total = partial(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "v"])

    parts = blocks.mapInArrow(run, f"cell bigint, v {kind}").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(len(parts), np.int64 if kind == "bigint" else np.float64)
    out[parts["cell"].to_numpy()] = parts["v"].to_numpy()
    return out


class Centred:
    """The centred fit list: exact count and sums, distributed products."""

    def __init__(self, blocks: DataFrame, d: int):
        self.blocks, self.d = blocks, d

        def count(batches):
            total = None
            for (x,) in _blocks(batches, d):
                one = np.concatenate([[len(x)], x.sum(axis=0)])
                total = one if total is None else total + one
            return total

        sums = _summed(blocks, count, "bigint")
        self.n, self.sums = (int(sums[0]), sums[1:]) if len(sums) else (0, np.zeros(d, np.int64))
        self.products = 0

    def product(self, block: np.ndarray) -> np.ndarray:
        """Covariance times ``block`` (dimension x k): one job."""
        d, n, sums, k = self.d, self.n, self.sums, block.shape[1]

        def multiply(batches):
            total = None
            for (x,) in _blocks(batches, d):
                z = (n * x - sums) / n
                one = z.T @ (z @ block)
                total = one if total is None else total + one
            return None if total is None else (total / n).ravel()

        self.products += 1
        return _summed(self.blocks, multiply, "double").reshape(d, k)


# -- Jacobi-Davidson ----------------------------------------------------------------

def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal basis of what ``new`` adds to the orthonormal ``against``."""
    scale = np.linalg.norm(new, axis=0)
    new = new[:, scale > 0] / scale[scale > 0]
    for _ in range(2):
        for basis in against:
            new = new - basis @ (basis.T @ new)
    if not new.shape[1]:
        return new
    u, s, _ = np.linalg.svd(new, full_matrices=False)
    new = u[:, s > 1e-10]
    for basis in against:
        new = new - basis @ (basis.T @ new)
    return np.linalg.qr(new)[0] if new.shape[1] else new


def minres(product, theta: np.ndarray, q: np.ndarray, r: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of ``(I - QQ')(A - theta_j I)(I - QQ') t_j = -r_j``, all columns at once."""
    away = lambda y: y - q @ (q.T @ y)
    r2 = away(-r)
    beta = np.linalg.norm(r2, axis=0)
    first = np.where(beta > 0, beta, 1.0)
    r1, y, x = np.zeros_like(r2), r2, np.zeros_like(r2)
    w = w2 = np.zeros_like(r2)
    old = np.ones_like(beta)
    dbar = epsln = sn = np.zeros_like(beta)
    cs, phibar = -np.ones_like(beta), beta.copy()
    tiny = np.finfo(float).tiny
    for step in range(steps):
        live = beta > 1e-14 * first  # a column that is solved stands still
        safe = np.where(live, beta, 1.0)
        v = np.where(live, y / safe, 0.0)
        y = away(product(v) - v * theta)
        if step:
            y = y - r1 * (beta / old)
        alfa = (v * y).sum(axis=0)
        y = y - r2 * (alfa / safe)
        r1, r2, old, beta = r2, y, safe, np.where(live, np.linalg.norm(y, axis=0), 0.0)
        old_eps, delta, gbar = epsln, cs * dbar + sn * alfa, sn * dbar - cs * alfa
        epsln, dbar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(gbar, beta), tiny)
        cs, sn = gbar / gamma, beta / gamma
        phi, phibar = np.where(live, cs * phibar, 0.0), sn * phibar
        w1, w2 = w2, w
        w = np.where(live, (v - old_eps * w1 - delta * w2) / gamma, 0.0)
        x = x + phi * w
    return away(np.where(np.isfinite(x), x, 0.0))


def leading_pairs(product, d: int, k: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues of a symmetric operator, their eigenvectors (columns),
    and the largest residual relative to the largest eigenvalue."""
    k = min(k, d)
    locked, room = np.zeros((d, 0)), min(d, 6 * k)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, 2 * k))))
    image = product(basis)
    best, still = np.inf, 0
    for _ in range(OUTER):
        values, mixed = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        order = np.argsort(-values)
        values, mixed = values[order], mixed[:, order]
        wanted = min(k - locked.shape[1], basis.shape[1])
        u, au = basis @ mixed[:, :wanted], image @ mixed[:, :wanted]
        away = au - u * values[:wanted]
        away = away - locked @ (locked.T @ away)
        size = np.linalg.norm(away, axis=0)
        top = values[0] if not locked.shape[1] else max(top, values[0])
        goal = TOLERANCE * max(abs(top), np.finfo(float).tiny)
        still = 0 if size.max() < best / 2 else still + 1  # rounding of the products may stop it just above
        best = min(best, size.max())
        if still >= 4 and size.max() <= 50 * goal:
            goal = size.max()
        done = 0
        while done < wanted and size[done] <= goal:
            done += 1
        full = basis.shape[1] + locked.shape[1] >= d
        if full:
            done = wanted
        locked = np.concatenate([locked, u[:, :done]], axis=1)
        if done:
            best, still = np.inf, 0
        if locked.shape[1] == k or full:
            break
        # thick restart, also after locking: the best pairs that are left
        keep = min(basis.shape[1], done + 2 * k) if basis.shape[1] + wanted > room or done else basis.shape[1]
        basis, image = basis @ mixed[:, done:keep], image @ mixed[:, done:keep]
        open_ = np.flatnonzero(size[done:] > goal) + done
        if not len(open_):
            continue
        q = np.concatenate([locked, u[:, done:]], axis=1)
        steps = minres(product, values[open_], q, away[:, open_], INNER)
        new = _orthonormal(np.concatenate([steps, away[:, open_]], axis=1) if not steps.any() else steps, locked, basis)
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(seed + basis.shape[1]).standard_normal((d, 1)), locked, basis)
        basis, image = np.concatenate([basis, new], axis=1), np.concatenate([image, product(new)], axis=1)
    else:
        raise ArithmeticError(f"no convergence: residual {best:.3g} after {OUTER} steps")
    # last Rayleigh-Ritz, with fresh products
    locked = np.linalg.qr(locked)[0]
    image = product(locked)
    values, mixed = np.linalg.eigh((locked.T @ image + image.T @ locked) / 2)
    order = np.argsort(-values)
    values, vectors = values[order], locked @ mixed[:, order]
    residual = np.linalg.norm(image @ mixed[:, order] - vectors * values, axis=0).max()
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs, float(residual / max(values[0], np.finfo(float).tiny))


# -- whitening ------------------------------------------------------------------------

def _trace(fit: Centred) -> float:
    d, n, sums = fit.d, fit.n, fit.sums

    def squares(batches):
        total = None
        for (x,) in _blocks(batches, d):
            one = (((n * x - sums) / n) ** 2).sum()
            total = one if total is None else total + one
        return None if total is None else np.array([total / n])

    return float(_summed(fit.blocks, squares, "double")[0])


def _project(fit: Centred, vectors: np.ndarray, values: np.ndarray):
    """Projection of one block of whole numbers."""
    return lambda x: ((n_x(x, fit) / fit.n) @ vectors) / np.sqrt(values)


def n_x(x: np.ndarray, fit) -> np.ndarray:
    return fit.n * x - fit.sums


def _identity_error(fit: Centred, project) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    d, n = fit.d, fit.n

    def gathered(work):
        def run(batches):
            total = None
            for (x,) in _blocks(batches, d):
                one = work(project(x))
                total = one if total is None else total + one
            return None if total is None else total.ravel() / n
        return _summed(fit.blocks, run, "double")

    mean = gathered(lambda w: w.sum(axis=0))
    k = len(mean)
    cov = gathered(lambda w: (w - mean).T @ (w - mean)).reshape(k, k)
    return float(np.abs(cov - np.eye(k)).max())


class _Numbers:
    """What tasks need of the fit list (plain numbers)."""

    def __init__(self, fit: Centred):
        self.n, self.sums = fit.n, fit.sums


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every
    remaining row of ``vectors`` (``vec_id, embedding``) and component."""
    spark = vectors.sparkSession
    out = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = whole_numbers(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"))
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")) \
        .agg(F.max(F.struct("n", "d"))["d"].alias("d")).first()
    if lengths["d"] is None:
        return spark.createDataFrame([], out)
    d = int(lengths["d"])
    blocks = materialize(rows.where(F.size("x") == d).mapInArrow(_pack(d), "ids array<bigint>, x binary, width int"))
    fit = Centred(blocks, d)
    trace = _trace(fit)
    if trace <= 0:
        release(blocks)
        return spark.createDataFrame([], out)
    values, axes, _ = leading_pairs(fit.product, d, components)
    real = values > d * np.finfo(float).eps * trace
    values, axes = values[real], axes[:, real]
    numbers = _Numbers(fit)
    project = _project(numbers, axes, values)
    error = _identity_error(fit, project)
    n, k, explained = fit.n, len(values), values / trace

    def rows_of(batches):
        for x, ids in _blocks(batches, d, ("ids",)):
            z = n_x(x, numbers)
            w = project(x)
            wide = (z.astype(np.float64) ** 2).sum(axis=1) >= 2.0**62
            deviation = [None if big else v for v, big in zip((z * z).sum(axis=1).tolist(), wide.tolist())]
            if wide.any():
                for i in np.flatnonzero(wide):
                    exact = sum(int(v) ** 2 for v in z[i])
                    deviation[i] = exact if exact < 2**63 else None
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [ids.values.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(w.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(rows_of, out)
