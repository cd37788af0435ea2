"""Positional encoding of a graph: eigenvectors of the normalised Laplacian.

The smallest eigenvalues of ``L = I - S`` belong to the largest of ``S``.  They are found by
subspace iteration with a Chebyshev filter.  The vectors are a DataFrame with one row per
node; every product with ``S`` is a join and an aggregate, and only matrices of the size of
the subspace (about twenty columns) reach the driver.

The filter's degree follows the gap between the wanted values and the cut.  A graph of many parts
has the value 1 many times, so the block lies within that cluster and the gap is next to nothing: a
short filter would gain a few percent a cycle, while the gain of a long one grows exponentially.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sensorgrid.operators.graph import scaled_adjacency
from sensorgrid.staging import release, stage

#: How much a filter may amplify the wanted vectors, and its largest degree.
GROWTH = 1e4
LONGEST = 128


def _multiply(links: DataFrame, rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with ``p_<name>`` columns holding ``S x``; nodes without edges get 0.

    Products are summed before the shuffle; the rows themselves only join the sums.
    """
    moved = links.join(rows.selectExpr("node_id AS dst", *names), "dst").selectExpr(
        "src AS node_id", *[f"s * {n} AS p_{n}" for n in names]
    )
    sums = moved.groupBy("node_id").agg(*[F.expr(f"sum(p_{n}) AS p_{n}") for n in names])
    products = [f"coalesce(p_{n}, 0D) AS p_{n}" for n in names]
    return rows.join(sums, "node_id", "left").selectExpr(*rows.columns, *products)


def _gram(rows: DataFrame, names: list[str]) -> np.ndarray:
    """``M^T M`` of the named columns: one partial product per task, added up in Spark."""
    width = len(names)

    def partial(batches):
        total = np.zeros((width, width))
        for batch in batches:
            block = batch.to_numpy(dtype=float)
            total += block.T @ block
        yield pd.DataFrame({"i": np.arange(width * width), "v": total.ravel()})

    parts = rows.select(*names).mapInPandas(partial, "i INT, v DOUBLE")
    sums = parts.groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width * width)
    for row in sums:
        out[row["i"]] = row["v"]
    return out.reshape(width, width)


def _combine(rows: DataFrame, names: list[str], weights: np.ndarray, out: list[str]) -> DataFrame:
    columns = [
        " + ".join(f"{source} * {float(weights[i, j])!r}D" for i, source in enumerate(names)) + f" AS {name}"
        for j, name in enumerate(out)
    ]
    return rows.selectExpr("node_id", *columns)


def _ritz(
    links: DataFrame, vectors: DataFrame, names: list[str], want: int
) -> tuple[np.ndarray, DataFrame, float]:
    """Rayleigh-Ritz step: eigenvalues (largest first), orthonormal vectors, and the largest
    residual ``|S v - theta v|`` of the first ``want``."""
    rows = stage(_multiply(links, vectors, names), "ritz")
    release(vectors)
    size = len(names)
    gram = _gram(rows, [*names, *[f"p_{n}" for n in names]])
    xx, xp, pp = gram[:size, :size], gram[:size, size:], gram[size:, size:]
    scale, basis = np.linalg.eigh(xx)
    keep = scale > scale.max() * 1e-12
    whiten = basis[:, keep] / np.sqrt(scale[keep])
    inner = whiten.T @ ((xp + xp.T) / 2) @ whiten
    values, turn = np.linalg.eigh(inner)
    order = np.argsort(values)[::-1]
    values, weights = values[order], whiten @ turn[:, order]
    worst = 0.0
    for j in range(min(want, len(values))):
        w, theta = weights[:, j], values[j]
        square = w @ pp @ w - 2 * theta * (w @ xp @ w) + theta**2 * (w @ xx @ w)
        worst = max(worst, float(np.sqrt(max(square, 0.0))))
    out = [f"x{j}" for j in range(weights.shape[1])]
    turned = _combine(rows, names, weights, out)
    turned._staged_at = rows._staged_at
    return values, turned, worst


def spectral_encoding(
    edges: DataFrame,
    nodes: DataFrame,
    k: int = 10,
    oversample: int = 6,
    degree: int = 8,
    cycles: int = 30,
    tol: float = 1e-4,
    seed: int = 42,
) -> tuple[list[float], DataFrame]:
    """The ``k`` smallest eigenvalues after the first, and ``node_id, pe0 .. pe{k-1}``.

    ``edges`` must be symmetric.  Stops when the largest residual ``|L v - lambda v|`` of the
    wanted vectors is below ``tol``; raises if it is not after ``cycles`` filters of at least ``degree``
    (runs jobs).
    Signs, and the basis of repeated eigenvalues, are arbitrary.
    """
    n = nodes.count()
    want = min(k + 1, n)
    block = min(want + oversample, n)
    names = [f"x{j}" for j in range(block)]
    scaled = stage(scaled_adjacency(edges), "scaled")
    links = scaled.where("s <> 0")
    start = nodes.select(
        "node_id",
        *[
            (F.pmod(F.xxhash64("node_id", F.lit(seed + j)), F.lit(2_000_003)) / 1_000_001.5 - 1.0).alias(c)
            for j, c in enumerate(names)
        ],
    )
    values, vectors, worst = _ritz(links, start, names, want)
    for _ in range(cycles):
        if worst < tol:
            break
        names = [c for c in vectors.columns if c != "node_id"]
        cut = float(values[-1])
        length = _degree(float(values[min(want, len(values)) - 1]), cut, 10 * worst / tol, degree)
        vectors = _filter(links, vectors, names, length, cut)
        values, vectors, worst = _ritz(links, vectors, names, want)
    if worst >= tol:
        raise RuntimeError(f"the spectral encoding has not converged: residual {worst:.2e} after {cycles} filters")
    chosen = list(range(1, min(want, len(values))))
    encoding = vectors.select("node_id", *[F.col(f"x{j}").alias(f"pe{j - 1}") for j in chosen])
    encoding = stage(encoding, "encoding")
    release(scaled, vectors)
    return [float(1.0 - values[j]) for j in chosen], encoding


def residuals(edges: DataFrame, values: list[float], encoding: DataFrame) -> list[tuple[float, float, float]]:
    """Of each vector of an encoding: its squared norm, its largest product with another vector,
    and its residual ``|L v - lambda v|`` (runs jobs; only products of vectors reach the driver)."""
    names = [c for c in encoding.columns if c != "node_id"]
    links = scaled_adjacency(edges).where("s <> 0")
    gram = _gram(_multiply(links, encoding, names), [*names, *[f"p_{n}" for n in names]])
    size = len(names)
    xx, xp, pp = gram[:size, :size], gram[:size, size:], gram[size:, size:]
    out = []
    for j, value in enumerate(values):
        theta = 1.0 - value
        square = pp[j, j] - 2 * theta * xp[j, j] + theta**2 * xx[j, j]
        others = np.abs(np.delete(xx[j], j)).max(initial=0.0)
        out.append((float(xx[j, j]), float(others), float(np.sqrt(max(square, 0.0)))))
    return out


def _damped(cut: float) -> tuple[float, float]:
    """Center and half width of the damped spectrum ``[-1, cut]``."""
    cut = min(max(cut, -0.9), 0.999)
    return (cut - 1.0) / 2.0, (cut + 1.0) / 2.0


def _degree(value: float, cut: float, growth: float, least: int) -> int:
    """Degree of the polynomial that is ``growth`` (at most ``GROWTH``) at the eigenvalue ``value``, from
    ``least`` to ``LONGEST``."""
    center, half = _damped(cut)
    rate = np.arccosh(max((value - center) / half, 1.0 + 1e-9))
    return int(np.clip(np.ceil(np.arccosh(np.clip(growth, 1.0, GROWTH)) / rate), least, max(least, LONGEST)))


def _filter(links: DataFrame, vectors: DataFrame, names: list[str], degree: int, cut: float) -> DataFrame:
    """Chebyshev polynomial of ``S`` that damps the spectrum in ``[-1, cut]``.

    The same expression is used in every step (``T_j+1 = 2 A T_j - T_j-1``), so its generated
    code is compiled once.
    """
    center, half = _damped(cut)

    rows, held = vectors, vectors
    for step in range(degree):
        # One table at a time is kept: a step's is written before the one it reads is deleted.
        written = stage(_multiply(links, rows, names), "filter")
        release(held)
        held = written
        scale = f"{half!r}D" if not step else f"{half!r}D * 2D - old_{{n}}"
        rows = written.selectExpr(
            "node_id",
            *[f"{n} AS old_{n}" for n in names],
            *[f"(p_{n} - {n} * {center!r}D) / {scale.format(n=n)} AS {n}" for n in names],
        )
    out = rows.select("node_id", *names)
    out._staged_at = held._staged_at
    return out
