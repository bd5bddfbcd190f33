"""Whitening of embeddings with a covariance in which equal vectors are fitted once.

Vectors are put on a grid of whole numbers first, so that equal ones can be grouped.  Each
different vector is one row with its count; the fit takes it with weight one or with that
count.  A first pass adds up weights and exact sums, a second one multiplies centred
vectors (one matrix product a batch) and adds up the products; the driver sees only these
sums, whose size depends on the dimension alone.  Every different vector is whitened once
and joined back to the rows that hold it.

Vectors of different lengths have nothing in common: each length is fitted on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_code

SCALE = 256
#: A vector that this share of all rows or more hold is joined back by broadcast; there are at most 1/HOT of them.
HOT = 1 / 256
#: An eigenvalue below this share of the largest is zero up to rounding.
FLAT = 1e-12
_EXACT = 1 << 62
_DIGITS = 10**38


def on_grid(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """Key (as ``k``) and ``x``, the vector in steps of 1/``scale``, of every row that has one.

    Rows whose vector is null or holds null, NaN or infinite entries are left out.  Steps
    beyond a 64-bit integer stay at its limits.
    """
    given = rows.select(F.col(f"`{key}`").alias("k"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return given.filter(F.col("v").isNotNull() & finite).select(
        "k", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(0)).alias("x"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length in a batch, the places of its vectors and their matrix."""
    column = batch.column("x")
    ends = column.offsets.to_numpy()
    sizes = np.diff(ends)
    values = column.values.to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == size)
        yield at, values[ends[at][:, None] + np.arange(size)]


def _exact(matrix: np.ndarray, terms: int, factor: int = 1, shift: list[int] | None = None, power: int = 1) -> np.ndarray:
    """``factor`` times the matrix less ``shift``, in 64-bit integers where sums of so many terms fit, else in Python's."""
    most = max(abs(int(matrix.min())), abs(int(matrix.max()))) * factor + max([0, *map(abs, shift or [])])
    if most**power * terms >= _EXACT:
        matrix = matrix.astype(object)
    return matrix if shift is None else matrix * factor - np.array(shift, matrix.dtype)


def _wide(values) -> pa.Array:
    return pa.array([Decimal(int(v)) if abs(int(v)) < _DIGITS else None for v in values], pa.decimal128(38, 0))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights and weighted sums of each dimension; ``i`` of -1 holds the weights."""
    for batch in batches:
        weights = batch.column("weight").to_numpy()
        for at, matrix in _matrices(batch):
            w = weights[at]
            exact = _exact(matrix, int(w.sum()))
            size = matrix.shape[1]
            totals = [int(w.sum()), *(w.astype(exact.dtype) @ exact)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * (size + 1), pa.int32()), pa.array(range(-1, size), pa.int32()), _wide(totals)],
                ["size", "i", "total"])


@dataclass
class Fit:
    """One length's weight, exact sums, mean, eigenvalues in falling order and unit eigenvectors in columns."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    trace: float = 0.0

    def projection(self, components: int | None) -> np.ndarray:
        """Columns that whiten a centred vector; those of flat directions are NaN."""
        k = min(len(self.values), components or len(self.values))
        e = self.values[:k]
        flat = e <= FLAT * max(float(self.values[0]), 0.0)
        return self.vectors[:, :k] / np.sqrt(np.where(flat, np.nan, e))


def fit(distinct: DataFrame) -> dict[int, Fit]:
    """Fits by length, of ``x`` with ``weight``; only sums come to the driver."""
    narrow = distinct.select("x", "weight")
    found: dict[int, dict[int, int]] = {}
    for row in narrow.mapInArrow(_sums, "size int, i int, total decimal(38,0)").groupBy("size", "i").agg(
            F.sum("total").alias("total")).collect():  # one number for each dimension
        found.setdefault(row["size"], {})[row["i"]] = int(row["total"])
    fits = {}
    for size, totals in found.items():
        n, sums = totals[-1], [totals[i] for i in range(size)]
        fits[size] = Fit(n, sums, np.array([s / n for s in sums]))
    means = {size: (one.n, one.mean) for size, one in fits.items()}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for at, matrix in _matrices(batch):
                n, mean = means[matrix.shape[1]]
                centred = matrix - mean
                part = (centred * (weights[at] / n)[:, None]).T @ centred
                held[len(mean)] = held.get(len(mean), 0.0) + part
        for size, part in held.items():
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(part[i, j])], ["size", "i", "j", "v"])

    if fits:
        sums = narrow.mapInArrow(products, "size int, i int, j int, v double").groupBy("size", "i", "j").agg(F.sum("v").alias("v")).toArrow()
        size, i, j, v = (sums[name].to_numpy() for name in ("size", "i", "j", "v"))
        for d, one in fits.items():
            own = size == d
            cov = np.zeros((d, d))
            cov[i[own], j[own]] = v[own]
            cov[j[own], i[own]] = v[own]
            e, vectors = np.linalg.eigh(cov)
            one.values, one.vectors = e[::-1], vectors[:, ::-1]
            leading = one.vectors[np.abs(one.vectors).argmax(axis=0), np.arange(d)]
            one.vectors = one.vectors * np.where(leading < 0, -1.0, 1.0)  # the largest coordinate is positive
            one.trace = float(np.trace(cov))
    return fits


def whiten_distinct(distinct: DataFrame, fits: dict[int, Fit], components: int | None = None) -> DataFrame:
    """Columns of ``distinct`` with ``n``, ``deviation`` and the array ``whitened``."""
    shared = distinct.sparkSession.sparkContext.broadcast(fits)  # a square of the dimension
    schema = "x array<bigint>, weight bigint, held bigint, n bigint, deviation decimal(38,0), whitened array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in _matrices(batch):
                one = shared.value[matrix.shape[1]]
                away = _exact(matrix, matrix.shape[1], one.n, one.sums, 2)
                white = (matrix - one.mean) @ one.projection(components)
                k = white.shape[1]
                flat = pa.array(white.ravel(), from_pandas=True)  # NaN as null
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(np.full(len(at), one.n)), _wide((away * away).sum(axis=1)),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * k, pa.int32()), flat)],
                    [*rows.schema.names, "n", "deviation", "whitened"])

    return distinct.select("x", "weight", "held").mapInArrow(run, schema)


def identity_errors(white: DataFrame, components: int) -> DataFrame:
    """For each length, the largest entry of the whitened covariance less the identity.

    The covariance is centred and over the fit's weights.  Flat directions do not count.
    """
    at = [F.try_element_at("whitened", F.lit(i + 1)) for i in range(components)]
    size, w = F.size("x").alias("size"), F.col("weight")
    means = white.groupBy(size).agg(*[(F.sum(a * w) / F.sum(w)).alias(f"m{i}") for i, a in enumerate(at)])
    # As many rows as there are lengths, which the driver has seen one by one.
    centred = white.withColumn("size", F.size("x")).join(F.broadcast(means), "size")
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    entries = [
        (F.sum((at[i] - F.col(f"m{i}")) * (at[j] - F.col(f"m{j}")) * w) / F.sum(w) - F.lit(float(i == j))) for i, j in pairs]
    return centred.groupBy("size").agg(F.array_max(F.array(*[F.abs(e) for e in entries])).alias("identity_error"))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int | None = None,
           weights: str = "one", scale: int = SCALE) -> DataFrame:
    """``key``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    One row for each row with a usable vector and each component, numbered from 1 by falling
    eigenvalue, up to ``components`` (all by default).  ``weights`` is ``one`` (each different
    vector once) or ``counts``.  Directions without variance have null in ``whitened``; where all
    are without, ``explained`` is null too.  ``deviation`` is exact, and null beyond 38 digits.
    Rows without a usable vector, or with an empty one, are left out; repeated rows and null
    keys are kept; other columns are ignored.  No rows give no rows.
    """
    if weights not in ("one", "counts"):
        raise ValueError("weights are one or counts")
    spark = rows.sparkSession
    ship_code(spark)
    points = on_grid(rows, key, vector, scale).filter(F.size("x") > 0)
    held = points.groupBy("x").agg(F.count(F.lit(1)).alias("held"))
    weight = F.lit(1).cast("bigint") if weights == "one" else F.col("held")
    distinct = materialize(held.select("x", weight.alias("weight"), "held"), "vectors")
    fits = fit(distinct)
    total = distinct.agg(F.sum("held")).first()[0] or 0
    most = max([min(d, components or d) for d in fits], default=1)
    white = materialize(whiten_distinct(distinct, fits, components), "whitened")
    shares = [(d, i + 1, float(e / one.trace) if one.trace > 0 else None)
              for d, one in fits.items() for i, e in enumerate(one.values[: components or d])]
    explained = spark.createDataFrame(shares, "size int, component int, explained double")
    errors = identity_errors(white, most)
    figures = F.broadcast(explained.join(errors, "size").groupBy("size").agg(
        F.sort_array(F.collect_list(F.struct("component", "explained", "identity_error"))).alias("figures")))
    table = white.withColumn("size", F.size("x")).join(figures, "size").select("x", "held", "n", "deviation", "whitened", "figures")
    # A vector that many rows hold would put them all into one task of a join; there are few such vectors.
    often = F.col("held") > F.lit(total * HOT)
    hot = points.join(F.broadcast(table.filter(often)), "x")
    rest = points.join(F.broadcast(table.filter(often).select("x")), "x", "left_anti").join(table.filter(~often), "x")
    both = hot.unionByName(rest)
    one = F.explode(F.arrays_zip("figures", "whitened")).alias("one")
    return both.select("k", "n", "deviation", one).select(
        F.col("k").alias(key), F.col("one.figures.component").alias("component"), "n", "deviation",
        F.col("one.whitened").alias("whitened"), F.col("one.figures.explained").alias("explained"),
        F.col("one.figures.identity_error").alias("identity_error"))
