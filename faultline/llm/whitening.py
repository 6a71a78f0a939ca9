"""Embedding whitening with eigenvectors from contour integrals (FEAST).

Spark sums the distinct integer vectors and their centred products; what is
left is one symmetric matrix as wide as a vector. Its leading eigenvalues are fenced off
into intervals whose ends are eigenvalue-free, by inertia counts alone. Each
interval is then a task of its own:

* the contour integral of (zI - V)^-1 over a circle through the interval's
  ends projects onto its eigenvectors; quadrature turns it into a few complex
  shifted solves applied to a block of vectors;
* Rayleigh-Ritz on the projected block gives eigenvalues and eigenvectors, and
  the block is projected again until the residuals are rounding errors;
* the inertia at both ends says how many eigenvalues the interval holds: a
  block that finds another number starts again with more vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import materialize, ship

ship(__name__)

SCALE = 256
COMPONENTS = 4

#: Widest vectors: the matrix and its solves must fit a task (four matrices of 128 MB).
MOST_DIMENSIONS = 4096
#: Quadrature points on the upper half of a circle, eigenvalues in an interval
#: before it is split, projections before more vectors are taken.
POINTS = 8
PER_INTERVAL = 16
ROUNDS = 12
#: Share of the largest eigenvalue below which there is no variance to whiten.
NO_VARIANCE = 1e-12


# -- one symmetric matrix ---------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with v's eigenvalues."""
    a = v.astype(np.float64).copy()
    n = len(a)
    off = np.zeros(max(n - 1, 0))
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        off[k] = norm
        if norm == 0:
            continue
        # reflect x onto the first axis, away from cancellation
        off[k] = -norm if x[0] > 0 else norm
        x[0] -= off[k]
        x /= np.linalg.norm(x)
        block = a[k + 1 :, k + 1 :]
        p = 2 * (block @ x)
        p -= (x @ p) * x
        block -= np.outer(x, p) + np.outer(p, x)
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diag(a).copy(), off


def inertia(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues below ``shift``: negative pivots of the shifted factorisation."""
    least = np.finfo(np.float64).tiny
    count, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        before = off[i - 1] if i else 0.0
        pivot = (d - shift) - before * before / pivot
        if abs(pivot) < least:
            pivot = -least
        count += pivot < 0
    return count


def intervals(v: np.ndarray, k: int, most: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), from the top down, together holding the
    k largest eigenvalues. Ends lie in gaps; only inertia counts are used."""
    diagonal, off = tridiagonal(v)
    n = len(diagonal)
    around = np.r_[0.0, np.abs(off)] + np.r_[np.abs(off), 0.0]
    bottom, top = float((diagonal - around).min()), float((diagonal + around).max())
    slack = max(abs(bottom), abs(top), np.finfo(np.float64).tiny) * 1e-3
    bottom, top = bottom - slack, top + slack

    def above(shift: float) -> int:
        return n - inertia(diagonal, off, shift)

    def largest(i: int) -> float:
        """The i-th largest eigenvalue, to a few digits, by bisection."""
        low, high = bottom, top
        for _ in range(40):
            middle = (low + high) / 2
            if not low < middle < high:
                break
            low, high = (middle, high) if above(middle) >= i else (low, middle)
        return (low + high) / 2

    values: dict[int, float] = {n + 1: bottom}

    def gap(i: int) -> tuple[float, float]:
        """Distance from the i-th largest to the next eigenvalue, and its middle."""
        for j in (i, i + 1):
            if j not in values:
                values[j] = largest(j)
        if i == n:
            return top - bottom, bottom
        return values[i] - values[i + 1], (values[i] + values[i + 1]) / 2

    out, done, high = [], 0, top
    while done < k:
        # end in the widest gap that leaves a block of bounded size
        first = k if k - done <= most else done + 1
        end = max(range(first, min(done + most, n) + 1), key=lambda i: gap(i)[0])
        # equal eigenvalues stay together, however many they are
        while gap(end)[0] <= 1e-6 * (top - bottom):
            end += 1
        low = gap(end)[1]
        count = above(low) - done
        if count:
            out.append((low, high, count))
        done, high = done + count, low
    return out


def contour(points: int) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre points on the upper half of the unit circle, with weights."""
    x, w = np.polynomial.legendre.leggauss(points)
    z = np.exp(1j * np.pi * (1 - x) / 2)
    return z, w


def feast(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of v in (low, high), falling, and their unit eigenvectors.

    ``count`` is what the inertia demands; anything else found is an error.
    """
    n = len(v)
    center, radius = (low + high) / 2, (high - low) / 2
    z, w = contour(POINTS)
    size = min(n, max(count + 4, count * 3 // 2))
    scale = max(abs(low), abs(high))
    while True:
        block = np.random.default_rng(size).standard_normal((n, size))
        for _ in range(ROUNDS):
            part = np.zeros_like(block)
            for point, weight in zip(z, w, strict=True):
                shifted = (center + radius * point) * np.eye(n) - v
                # both halves of the circle: twice the real part
                part += weight / 2 * radius * np.real(point * np.linalg.solve(shifted, block))
            basis, triangle = np.linalg.qr(part)
            # directions that the projection wiped out carry nothing
            alive = np.abs(np.diag(triangle)) > np.abs(triangle).max() * 1e-14
            basis = basis[:, alive]
            reduced = basis.T @ v @ basis
            values, turn = np.linalg.eigh((reduced + reduced.T) / 2)
            vectors = basis @ turn
            inside = (values > low) & (values < high)
            error = np.linalg.norm(v @ vectors - vectors * values, axis=0)[inside]
            if inside.sum() == count and (not count or error.max() <= 1e-13 * scale * np.sqrt(n)):
                by = np.argsort(-values[inside], kind="stable")
                return values[inside][by], vectors[:, inside][:, by]
            block = vectors
            if block.shape[1] < size:
                fresh = np.random.default_rng(n + size).standard_normal((n, size - block.shape[1]))
                block = np.c_[block, fresh]
        if size == n:
            break
        size = min(n, 2 * size)
    raise ArithmeticError(f"{inside.sum()} eigenvalues found between {low} and {high}, inertia says {count}")


def solve_intervals(spark: SparkSession, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of v and their unit eigenvectors, a task an interval."""
    fences = [(float(low), float(high), int(n)) for low, high, n in intervals(v, k)]
    held = spark.sparkContext.broadcast(v)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                values, vectors = feast(held.value, row.low, row.high, row.count_inside)
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    todo = spark.createDataFrame(fences, "low double, high double, count_inside int")
    found = todo.repartition(len(fences), "low").mapInPandas(run, "value double, vector array<double>")
    # at most k + PER_INTERVAL vectors
    rows = sorted(found.collect(), key=lambda r: -r["value"])[:k]
    return np.array([r["value"] for r in rows]), np.array([r["vector"] for r in rows]).T


# -- jobs -------------------------------------------------------------------


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, x): rows with a usable vector; components as integers."""
    c = F.col(f"`{embedding}`").cast("array<double>")
    usable = F.forall(
        c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float(2**44)))
    )
    x = F.transform(c, lambda v: F.floor(v * F.lit(float(SCALE))))
    return vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.when(usable & (F.size(c) > 0), x).alias("x"),
    ).where("x is not null")


def matrix(part: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.int64) for x in part])


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Vectors and exact sums of each component."""

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, high, low = 0, 0, 0
        for part in parts:
            x = matrix(part["x"])
            n += len(x)
            # halves of 32 bits: no sum overflows
            high = high + (x >> 32).sum(axis=0)
            low = low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pd.DataFrame({"at": range(len(high)), "n": n, "high": high, "low": low})

    partial = fit.mapInPandas(add, "at int, n long, high long, low long")
    rows = partial.groupBy("at").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    rows = sorted(rows.collect(), key=lambda r: r["at"])
    return rows[0]["n"], [(r["high"] << 32) + r["low"] for r in rows]


def summed_products(rows: DataFrame, part_of, width: int) -> np.ndarray:
    """Sum over all rows of the (width x width) matrices that ``part_of`` adds up."""

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for part in parts:
            total += part_of(matrix(part["x"]))
        yield pd.DataFrame({"at": range(width), "row": list(total)})

    partial = rows.mapInPandas(add, "at int, row array<double>")
    cells = partial.select("at", F.posexplode("row").alias("j", "v")).groupBy("at", "j").agg(F.sum("v").alias("v"))
    lines = cells.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("row"))
    out = np.zeros((width, width))
    for r in lines.collect():
        out[r["at"]] = [c["v"] for c in r["row"]]
    return out


def exact_deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over components of (n*x - S)^2, exact; null beyond 64 bits."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, total))
    if most * most * x.shape[1] < 2**63:
        d = n * x - np.array(total, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = n * x.astype(object) - np.array(total, object)
    return [v if v < 2**63 else None for v in (d * d).sum(axis=1).tolist()]


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    x = floor(256 * component); mean and covariance are over the distinct x.
    A row gives one output row for each of the ``components`` largest eigenvalues:
    its centred x projected on the unit eigenvector, over the eigenvalue's
    root. ``identity_error`` is measured on the whitened distinct vectors.

    Rows with a null vector or with a null, NaN or infinite component take no
    part, nor do empty vectors, components of 2^44 and beyond, and vectors
    of another length than the commonest (of equally common ones the longest).
    A null vec_id and repeated rows are rows like any other. Eigenvalues without
    variance (a share of 1e-12 of the largest or less) have no component, so equal vectors and an
    empty table give no row. A deviation beyond 64 bits is null. Other columns
    do not matter, whatever their names.
    """
    spark = vectors.sparkSession
    result = (
        "vec_id long, component int, n long, deviation long, whitened double,"
        " explained double, identity_error double"
    )
    rows = integer_vectors(vectors, vec_id, embedding)
    by_width = rows.groupBy(F.size("x").alias("width")).count()
    common = by_width.orderBy(F.desc("count"), F.desc("width")).first()
    if common is None:
        return spark.createDataFrame([], result)
    width = common["width"]
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {width} components, more than {MOST_DIMENSIONS}")
    # a null id would turn the ids of its batch into doubles
    rows = rows.where(F.size("x") == width).select(
        F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("unnamed"), "x"
    )
    # equal vectors combine before the shuffle, so one that a third of all rows share is one row a task
    fit = materialize(rows.groupBy("x").count().select("x"), "whitening-fit")
    n, total = sums(fit)
    mean = np.array([s / n for s in total])

    def centred(x: np.ndarray) -> np.ndarray:
        d = x - mean
        return d.T @ d

    v = summed_products(fit, centred, width) / n
    v = (v + v.T) / 2
    trace = float(np.trace(v))
    if not trace > 0:
        return spark.createDataFrame([], result)
    values, directions = solve_intervals(spark, v, min(components, width))
    some = values > NO_VARIANCE * values[0]
    values, directions = values[some], directions[:, some]
    k = len(values)
    scaled = directions / np.sqrt(values)

    def whitened_products(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ scaled
        return y.T @ y

    identity = summed_products(fit, whitened_products, k) / n
    error = float(np.abs(identity - np.eye(k)).max())

    def project(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            x = matrix(part["x"])
            y = (x - mean) @ scaled
            names = pd.arrays.IntegerArray(
                part["vec_id"].to_numpy(np.int64), part["unnamed"].to_numpy(bool)
            )
            yield pd.DataFrame(
                {
                    "vec_id": names.repeat(k),
                    "component": np.tile(np.arange(1, k + 1), len(x)),
                    "n": n,
                    "deviation": pd.array(exact_deviations(x, n, total), "Int64").repeat(k),
                    "whitened": y.ravel(),
                    "explained": np.tile(values / trace, len(x)),
                    "identity_error": error,
                }
            )

    return rows.mapInPandas(project, result)
