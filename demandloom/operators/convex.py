"""Weights of component forecasts by convex minimisation, for all groups at once, with a certificate.

The loss of a group is convex in its weights. A round evaluates a few points of every group in one aggregation: the losses and subgradients there are sums over rows. Each gives a plane under the loss.
The least of the planes' upper envelope over the box is a lower bound of every loss, so the best point found is known to be within the gap between the two. It
is a small linear program, solved for each group by the simplex method on its dual, whose every feasible point is such a bound.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.boosting import FEW, held
from demandloom.operators.tables import cut

PARTS = ("s", "c", "rf")
#: Points of a group in a round.
POINTS = 10


def envelope(slopes: np.ndarray, offsets: np.ndarray, most: float) -> tuple[np.ndarray, float]:
    """Where in [0, most]^n the largest of the planes slope . w + offset is least, and a lower bound of that value."""
    k, n = slopes.shape
    # The dual: shares of the planes whose mean slope is met by the box's sides.
    matrix = np.r_[np.ones((1, k)), slopes.T]
    sides = np.r_[np.zeros((1, n)), np.eye(n)]
    matrix = np.c_[matrix, sides, -sides]
    gain = np.r_[offsets, np.full(n, -most), np.zeros(n)]
    first = int(np.argmax(offsets))
    basis = np.array([first, *[k + j if slopes[first, j] < 0 else k + n + j for j in range(n)]])
    target = np.r_[1.0, np.zeros(n)]
    for turn in range(500):
        square = matrix[:, basis]
        prices = np.linalg.solve(square.T, gain[basis])
        rest = gain - matrix.T @ prices
        rest[basis] = 0.0
        better = np.flatnonzero(rest > 1e-12)
        if not len(better):
            break
        # The least number of those that gain ends what circles.
        enter = int(better[np.argmax(rest[better])]) if turn < 200 else int(better[0])
        way, now = np.linalg.solve(square, matrix[:, enter]), np.linalg.solve(square, target)
        steps = np.where(way > 1e-12, np.maximum(now, 0.0) / np.where(way > 1e-12, way, 1.0), np.inf)
        if not np.isfinite(steps).any():
            break
        out = np.flatnonzero(steps == steps.min())
        basis[out[np.argmin(basis[out])]] = enter
    shares = np.maximum(np.linalg.solve(matrix[:, basis], target), 0.0)
    # Rounding may leave the shares a little off the constraints: what the bound rests on is mended to hold exactly.
    own = np.zeros(matrix.shape[1])
    own[basis] = shares
    planes = own[:k] / own[:k].sum()
    bound = float(planes @ offsets + np.minimum(planes @ slopes, 0.0) @ np.full(n, most))
    return np.clip(-prices[1:], 0.0, most), bound


def next_points(planes: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """The points of the next round, the best one so far, its loss, and the lower bound. planes: rows of weights, loss, subgradient."""
    n = (planes.shape[1] - 1) // 2
    at, loss, slopes = planes[:, :n], planes[:, n], planes[:, n + 1 :]
    best = at[np.lexsort((*at.T[::-1], loss))[0]]
    low, bound = envelope(slopes, loss - (slopes * at).sum(axis=1), most)
    between = [low + share * (best - low) for share in (0.25, 0.5, 0.75)]
    step = max(1e-7, float(np.abs(best - low).max()) / 4)
    around = [best + sign * step * side for side in np.eye(n) for sign in (-1.0, 1.0)]
    points = np.clip(np.array([low, *between, *around]), 0.0, most)
    return np.resize(points, (POINTS, n)), best, float(loss.min()), bound


def _drawn(groups: DataFrame, toward: DataFrame, by: list[str]) -> DataFrame:
    """groups with the weights that each is drawn to, _toward."""
    shared = [c for c in toward.columns if c in by]
    near = toward.select(*[F.col(c).alias(f"_t_{c}") for c in shared], F.col("weights").alias("_toward"))
    if not shared:
        return groups.join(F.broadcast(near.limit(1)), F.lit(True), "left")
    return groups.join(near, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in shared], "left").drop(*[f"_t_{c}" for c in shared])


def fit_convex(
    df: DataFrame, by: list[str], tolerance: float = 0.02, most: float = 3.0, gap: float = 1e-4, penalty: float = 200.0, parts: Sequence[str] = PARTS, rounds: int = 40,
    toward: DataFrame | None = None, alpha: float = 0.0, squared: bool = False,
) -> DataFrame:
    """by, weights (in [0, most]), loss, gap: what the group's least loss may be below `loss` at most, `gap` or less unless the rounds end before.

    Loss: WAPE of the weighted sum plus the penalty times the square of what its bias falls short of the last part's own bias (if negative) less the tolerance. Null values count as 0. df is at the
    grain that is scored, with columns parts and actual. One aggregation a round serves all groups; groups without a positive total count as of total 1e-9.
    toward: weights for some of the columns `by`, or one row for all; alpha times the sum of the absolute (if squared, the squared) distances from them is added to the loss.
    """
    n = len(parts)
    rows = cut(df.select(*by, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in (*parts, "actual")]))
    start = [[0.0] * (n - 1) + [1.0], *[[float(i == j) for j in range(n)] for i in range(n - 1)], [1 / n] * n, [0.0] * n, [most] * n, [0.5] * n, [1.0] * n, [most / 2] * n]
    points = [x for p in (start * POINTS)[:POINTS] for x in p]
    groups = rows.groupBy(*by).agg(F.greatest(F.sum("actual"), F.lit(1e-9)).alias("_a"), F.sum(F.col(parts[-1]) - F.col("actual")).alias("_b"))
    groups = groups.withColumn("_toward", F.lit(None).cast("array<double>")) if toward is None else _drawn(groups, toward, by)
    groups = groups.withColumns({"_planes": F.array().cast("array<double>"), "_points": F.array(*[F.lit(x) for x in points]), "weights": F.array().cast("array<double>"), "loss": F.lit(None).cast("double"), "gap": F.lit(None).cast("double")})
    few = groups.limit(FEW + 1).count() <= FEW
    groups = held(groups, few)
    names = [f"_g{i}" for i in range(len(by))]
    sums = []
    for p in range(POINTS):
        e = " + ".join(f"_points[{p * n + j}] * `{c}`" for j, c in enumerate(parts)) + " - actual"
        sums += [f"sum(abs({e})) e{p}", f"sum({e}) d{p}", *[f"sum(signum({e}) * `{c}`) s{p}_{j}" for j, c in enumerate(parts)]]
    sums += [f"sum(`{c}`) x{j}" for j, c in enumerate(parts)]
    fields = [f"e{p} d{p} " + " ".join(f"s{p}_{j}" for j in range(n)) for p in range(POINTS)]
    order = [f for x in fields for f in x.split()] + [f"x{j}" for j in range(n)]
    state = ["_a", "_b", "_toward", "_planes", "_points", "weights", "loss", "gap"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {c: [] for c in state[3:]}
            found = np.array([b.column(c).to_numpy(zero_copy_only=False) for c in order]).T
            for i in range(b.num_rows):
                total, own = b.column("_a")[i].as_py(), b.column("_b")[i].as_py()
                at = np.array(b.column("_points")[i].as_py()).reshape(POINTS, n)
                data, x = found[i, : POINTS * (2 + n)].reshape(POINTS, 2 + n), found[i, POINTS * (2 + n) :]
                short = np.maximum(min(own / total, 0.0) - tolerance - data[:, 1] / total, 0.0)
                slopes = data[:, 2:] / total - 2 * penalty * short[:, None] * x / total
                losses = data[:, 0] / total + penalty * short**2
                if (home := b.column("_toward")[i].as_py()) is not None:
                    away = at - np.array(home)
                    losses = losses + alpha * ((away**2).sum(axis=1) if squared else np.abs(away).sum(axis=1))
                    slopes = slopes + alpha * (2 * away if squared else np.sign(away))
                new = np.c_[at, losses, slopes]
                planes = np.r_[np.array(b.column("_planes")[i].as_py()).reshape(-1, 2 * n + 1), new]
                following, best, loss, bound = next_points(planes, most)
                for c, v in zip(state[3:], (planes.ravel(), following.ravel(), best, loss, max(0.0, loss - bound)), strict=True):
                    out[c].append(v)
            lists = [pa.array(out[c], pa.list_(pa.float64())) for c in ("_planes", "_points", "weights")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in (*names, "_a", "_b", "_toward")], *lists, pa.array(out["loss"], pa.float64()), pa.array(out["gap"], pa.float64())], [*names, *state])

    for _ in range(rounds):
        now = groups.toDF(*names, *state)
        if now.where(F.col("gap").isNull() | (F.col("gap") > gap)).isEmpty():
            break
        asked = now.where(F.col("gap").isNull() | (F.col("gap") > gap))
        on = [F.col(c).eqNullSafe(F.col(g)) for c, g in zip(by, names, strict=True)]
        asked_points = asked.select(*names, "_points")
        met = rows.join(F.broadcast(asked_points) if few else asked_points, on)
        found = met.groupBy(*names).agg(*[F.expr(s) for s in sums])
        both = asked.join(found.withColumnsRenamed({g: f"_r{g}" for g in names}), [F.col(g).eqNullSafe(F.col(f"_r{g}")) for g in names]).select(*names, *state, *order)
        done = both.mapInArrow(each, now.schema)
        groups = held(done.unionByName(now.where(F.col("gap") <= gap)), few)
    return groups.toDF(*by, *state).select(*by, "weights", "loss", "gap")


def fit_levels(df: DataFrame, levels: list[list[str]], alpha: float, squared: bool = False, **options: float) -> DataFrame:
    """fit_convex of the last level, each level drawn to the weights of the one before by alpha; levels from coarse to fine, each with the columns of the one before, the first may be []."""
    fit = None
    for by in levels:
        rows, own = (df, by) if by else (df.withColumn("_all", F.lit(1)), ["_all"])
        fit = fit_convex(rows, own, toward=fit, alpha=alpha, squared=squared, **options)
        fit = fit if by else fit.drop("_all")
    return fit
