"""Gaussian mixtures of rows with many dimensions: projection first, then all fits in the same passes.

Distance rows have as many dimensions as there are isolates. They are projected onto their leading
principal coordinates by a randomised range finder; only matrices as wide as the projection reach
the driver. The mixtures of every number of clusters are then fitted together: one pass over the
projected rows sums what every component of every mixture needs for its next step.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.session import materialise

# Smallest variance added to a covariance diagonal.
RIDGE = 1e-6
#: Dimensions that are kept, directions drawn beyond them, columns of a block, rows that starting points are drawn from.
DIMS, SPARE, BLOCK, STARTERS = 8, 8, 1024, 2000


def _rows(batch: pa.RecordBatch, name: str) -> np.ndarray:
    lists = batch[name]
    width = len(lists[0]) if len(lists) else 0
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), width)


def _directions(block: int, width: int, seed: int) -> np.ndarray:
    """Random directions for one block of columns: the same in every task."""
    return np.random.default_rng((seed, block)).standard_normal((BLOCK, width))


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """Element by element sum of ``values`` over all rows of ``parts``, by place."""
    cells = parts.select(F.posexplode("values").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(size)
    for r in cells:
        out[r["i"]] = r["x"]
    return out


def projected(rows: DataFrame, dims: int = DIMS, seed: int = 0) -> DataFrame:
    """``(id, features)`` with at most ``dims`` dimensions: leading principal coordinates of longer rows, shorter ones as they are.

    Rows are multiplied by random directions drawn per block of columns; the span of the
    products is made orthogonal through their Gram matrix, and the singular vectors of the rows
    within that span follow from sums over blocks of columns. No task holds more than its
    rows and one block, and no table that grows with the rows or columns reaches the driver.
    """
    rows = rows.select("id", F.col("features").cast("array<double>").alias("features"))
    head = rows.select(F.size("features").alias("n")).first()
    if head is None or head["n"] <= dims:
        return rows
    width = min(head["n"], dims + SPARE)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                x = _rows(part, "features")
                y = np.zeros((len(x), width))
                for b in range(0, x.shape[1], BLOCK):
                    block = x[:, b : b + BLOCK]
                    y += block @ _directions(b // BLOCK, width, seed)[: block.shape[1]]
                yield pa.RecordBatch.from_arrays([part["id"], part["features"], pa.array(y.tolist(), pa.list_(pa.float64()))], ["id", "features", "y"])

    kind = rows.schema["id"].dataType.simpleString()
    sketched = materialise(rows.mapInArrow(sketch, f"id {kind}, features array<double>, y array<double>"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + width + width * width)
        for batch in batches:
            if batch.num_rows:
                y = _rows(batch, "y")
                total += np.concatenate([[len(y)], y.sum(0), (y.T @ y).ravel()])
        yield pa.RecordBatch.from_pydict({"values": pa.array([total.tolist()], pa.list_(pa.float64()))})

    flat = _summed(sketched.select("y").mapInArrow(sums, "values array<double>"), 1 + width + width * width)
    n, mean = flat[0], flat[1 : 1 + width] / flat[0]
    products = flat[1 + width :].reshape(width, width)
    value, vector = np.linalg.eigh(products - n * np.outer(mean, mean))
    good = value > max(np.trace(products), 0) * 1e-13  # less is rounding
    if not good.any():
        return rows.select("id", F.array(F.lit(0.0)).alias("features"))
    whiten = vector[:, good] / np.sqrt(value[good])  # y @ whiten has orthonormal columns
    rank = whiten.shape[1]

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                own = ((_rows(part, "y") - mean) @ whiten).T @ _rows(part, "features")
                total = own if total is None else total + own
        if total is not None:
            for b in range(0, total.shape[1], BLOCK):
                block = total[:, b : b + BLOCK]
                yield pa.RecordBatch.from_pydict({"block": [b // BLOCK], "width": [block.shape[1]], "values": pa.array([block.ravel().tolist()], pa.list_(pa.float64()))})

    parts = sketched.select("features", "y").mapInArrow(within, "block long, width long, values array<double>")

    def outer(table: pa.Table) -> pa.Table:
        block = np.sum([np.array(v) for v in table["values"].to_pylist()], axis=0).reshape(rank, table["width"][0].as_py())
        return pa.table({"values": pa.array([(block @ block.T).ravel().tolist()], pa.list_(pa.float64()))})

    inner = _summed(parts.groupBy("block").applyInArrow(outer, "values array<double>"), rank * rank).reshape(rank, rank)
    value, vector = np.linalg.eigh(inner)
    lead = np.argsort(-value)[:dims]
    turn = whiten @ (vector[:, lead] * np.sqrt(np.maximum(value[lead], 0)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = (_rows(batch, "y") - mean) @ turn
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(z.tolist(), pa.list_(pa.float64()))], ["id", "features"])

    return sketched.select("id", "y").mapInArrow(place, f"id {kind}, features array<double>")


Mixture = tuple[np.ndarray, np.ndarray, np.ndarray]  # weights, means, covariances


def _log_density(x: np.ndarray, mixture: Mixture) -> np.ndarray:
    """log of weight times density of every component at every row."""
    out = []
    for weight, mean, cov in zip(*mixture):
        factor = np.linalg.cholesky(cov + RIDGE * np.eye(len(mean)))
        z = np.linalg.solve(factor, (x - mean).T)
        out.append(np.log(max(weight, 1e-300)) - 0.5 * len(mean) * math.log(2 * math.pi) - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(0))
    return np.stack(out, axis=1)


def _step(rows: DataFrame, mixtures: list[Mixture]) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray]]:
    """One pass: for each mixture its log-likelihood, and the weights, sums and products of its components."""
    d = mixtures[0][1].shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(mixtures)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x, out = _rows(batch, "features"), []
                for m in shared.value:
                    each = _log_density(x, m)
                    top = each.max(1, keepdims=True)
                    whole = top[:, 0] + np.log(np.exp(each - top).sum(1))
                    r = np.exp(each - whole[:, None])
                    products = np.einsum("nk,ni,nj->kij", r, x, x, optimize=True)
                    out += [[whole.sum()], r.sum(0), (r.T @ x).ravel(), products.ravel()]
                flat = np.concatenate(out)
                total = flat if total is None else total + flat
        if total is not None:
            yield pa.RecordBatch.from_pydict({"values": pa.array([total.tolist()], pa.list_(pa.float64()))})

    sizes = [1 + len(w) * (1 + d + d * d) for w, _, _ in mixtures]
    flat = _summed(rows.select("features").mapInArrow(work, "values array<double>"), sum(sizes))
    out = []
    for part, (w, _, _) in zip(np.split(flat, np.cumsum(sizes)[:-1]), mixtures):
        k = len(w)
        out.append((float(part[0]), part[1 : 1 + k], part[1 + k : 1 + k + k * d].reshape(k, d), part[1 + k + k * d :].reshape(k, d, d)))
    return out


def _spread_points(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k starting means among ``points``: each drawn by its squared distance to those before it."""
    means = [points[rng.integers(len(points))]]
    while len(means) < k:
        far = np.min([((points - m) ** 2).sum(1) for m in means], axis=0)
        means.append(points[rng.choice(len(points), p=far / far.sum()) if far.sum() > 0 else rng.integers(len(points))])
    return np.array(means)


def fits(rows: DataFrame, max_clusters: int, seed: int = 0, starts: int = 3, max_rounds: int = 60, tol: float = 1e-5) -> tuple[int, dict[int, tuple[float, Mixture]]]:
    """Number of rows, and for each number of clusters the best log-likelihood and mixture over several starts.

    All mixtures whose log-likelihood still grows by more than the share ``tol`` take a step in the same pass. Starting
    means come from at most ``STARTERS`` rows drawn by a hash of their id.
    """
    drawn = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(STARTERS).select("features").collect()
    points = np.array([r["features"] for r in drawn], np.float64)
    d = points.shape[1]
    around = np.cov(points.T, bias=True).reshape(d, d)
    rng = np.random.default_rng(seed)
    plans = [(1, (np.ones(1), points.mean(0, keepdims=True), around[None]))]
    for k in range(2, max_clusters + 1):
        for _ in range(starts):
            plans.append((k, (np.full(k, 1 / k), _spread_points(points, k, rng), np.repeat(around[None] / k, k, axis=0))))
    best: dict[int, tuple[float, Mixture]] = {}
    n, before = 0, [-math.inf] * len(plans)
    alive = list(range(len(plans)))
    for _ in range(max_rounds):
        found = _step(rows, [plans[i][1] for i in alive])
        still = []
        for i, (loglik, weight, total, products) in zip(alive, found):
            k, mixture = plans[i]
            if k not in best or loglik > best[k][0]:
                best[k] = (loglik, mixture)
            n = int(round(weight.sum()))
            if loglik - before[i] > tol * max(1.0, abs(loglik)):
                safe = np.maximum(weight, 1e-10)
                means = total / safe[:, None]
                plans[i] = (k, (weight / weight.sum(), means, products / safe[:, None, None] - means[:, :, None] * means[:, None, :]))
                before[i] = loglik
                still.append(i)
        alive = still
        if not alive:
            break
    return n, best


def bic(n: int, d: int, k: int, loglik: float) -> float:
    """Bayesian information criterion of a full-covariance mixture."""
    params = (k - 1) + k * d + k * d * (d + 1) // 2
    return params * math.log(n) - 2 * loglik


def mixture(rows: DataFrame, max_clusters: int = 10, seed: int = 0, dims: int = DIMS) -> tuple[DataFrame, list[tuple[int, float]]]:
    """``(id, cluster)`` of the Gaussian mixture with the lowest BIC, and the BIC of every number of clusters.

    Rows longer than ``dims`` are clustered by their ``projected`` coordinates.
    """
    short = materialise(projected(rows, dims, seed))
    n = short.count()
    _, best = fits(short, min(max_clusters, n), seed)
    d = best[1][1][1].shape[1]
    trace = [(k, bic(n, d, k, loglik)) for k, (loglik, _) in sorted(best.items())]
    chosen = best[min(trace, key=lambda t: (t[1], t[0]))[0]][1]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = np.argmax(_log_density(_rows(batch, "features"), chosen), axis=1)
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(own, pa.int32())], ["id", "cluster"])

    kind = short.schema["id"].dataType.simpleString()
    return short.mapInArrow(label, f"id {kind}, cluster int"), trace
