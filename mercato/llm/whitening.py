"""Operator 12, embedding whitening by a covariance weighted with multiplicities.

Vectors become integers, equal ones are grouped, and everything after that runs
over distinct vectors:

* ``distinct_vectors`` counts the copies of each vector (partial counts before the
  shuffle, so a vector that a third of all rows hold costs no more than others).
* ``fit`` takes per-dimension sums, then one weighted product: each partition
  centres its distinct vectors, multiplies them with themselves weighted by their
  copies (or by one), and its matrix is added to the others'.  Centring uses
  ``(n * x - S) / n``, integers up to the division, so nothing cancels.  The driver
  gets one matrix of dimension x dimension entries and takes its eigenvectors.
* ``transform`` whitens every distinct vector once.  ``whiten`` joins the results back
  to the rows.  A vector with more than a thousandth of all rows is *hot*: there
  are fewer than a thousand, their results are copied under ``SALTS`` salts, and their rows are
  dealt over these.

Defined cases: a row whose vector is null, empty, or holds a null or non-finite
entry is dropped, as is one with an entry beyond ``LARGEST`` in size (its integer
would be no long) or with another number of entries than most rows (ties: the
larger number); null and repeated ids stay one row each; an exact squared deviation
beyond a long is null; a component without variance (an eigenvalue within rounding of zero)
has a null ``whitened`` and is no part of ``identity_error``; without any variance
``explained`` and ``identity_error`` are null; components are signed so that their
largest entry in size is positive; fewer dimensions than components give fewer
rows; extra columns are ignored, whatever their names; an empty table returns no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.common import reuse_checkpointed

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 50)
SALTS, HOT_ROWS = 64, 256
_EXACT = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learned: weight and sums of the fit list, and its components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray  # [k]
    components: np.ndarray  # [dimension, k]
    trace: float

    @property
    def usable(self) -> np.ndarray:
        """Components whose eigenvalue is above rounding."""
        tiny = len(self.sums) * np.finfo(float).eps * max(self.trace, 0.0)
        return self.eigenvalues > tiny


def matrix(column: pa.ListArray, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def from_mean(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - S``, exact: 64-bit integers where they hold it, else Python's."""
    most = max(int(np.abs(x).max(initial=0)) * n, *(abs(s) for s in sums))
    kind = np.int64 if 2 * most < _EXACT else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, x array<bigint>`` of the rows that can be used: ``floor(64 * c) + 1000000`` of each entry."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col(column).cast("array<double>").alias("entries"))
    # NaN counts as the largest double, so it is beyond LARGEST too.
    sound = F.forall("entries", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))
    rows = rows.where(F.col("entries").isNotNull() & (F.size("entries") > 0) & sound)
    most = rows.groupBy(F.size("entries").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    x = F.transform("entries", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    return rows.where(F.size("entries") == (most["d"] if most else 0)).select("vec_id", x.alias("x"))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``x, copies`` of every distinct vector, written once: the fit and the transformation both read it."""
    return reuse_checkpointed(rows.groupBy("x").agg(F.count("*").alias("copies")))


def covariance(table: DataFrame, column: str, dimension: int, n: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``sum(copies * c c^T) / n`` over the centred vectors ``c`` of a column."""

    def products(batches):
        total = None
        for b in batches:
            c = centred(matrix(b.column(0), dimension))
            part = (c * b.column(1).to_numpy(zero_copy_only=False)[:, None]).T @ c
            total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch(
                [pa.array(range(dimension), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "part"]
            )

    parts = table.select(column, "copies").mapInArrow(products, "i int, part array<double>")
    sums = parts.groupBy("i").agg(F.array(*(F.sum(F.col("part")[j]) for j in range(dimension))).alias("row"))
    out = np.zeros((dimension, dimension))
    for r in sums.collect():  # one row for each dimension
        out[r["i"]] = r["row"]
    return (out + out.T) / (2 * n)


def fit(distinct: DataFrame, components: int = COMPONENTS, weights: str = "copies") -> Whitening | None:
    """Components of the covariance of all vectors (``weights="copies"``) or of the distinct ones (``"one"``)."""
    if weights not in ("copies", "one"):
        raise ValueError("weights are 'copies' or 'one'")
    if weights == "one":
        distinct = distinct.withColumn("copies", F.lit(1).cast("long"))
    first = distinct.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    exact = [F.sum(F.col("x")[j].cast("decimal(19,0)") * F.col("copies").cast("decimal(18,0)")).alias(f"s{j}") for j in range(d)]
    row = distinct.agg(F.sum("copies").alias("n"), *exact).first()
    n, sums = int(row["n"]), tuple(int(row[f"s{j}"]) for j in range(d))
    v = covariance(distinct, "x", d, n, lambda x: from_mean(x, n, sums).astype(float) / n)
    e, u = np.linalg.eigh(v)
    e, u = np.maximum(e[::-1][:components], 0.0), u[:, ::-1][:, :components]
    signs = np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    return Whitening(n, sums, e, u * np.where(signs == 0, 1, signs), float(np.trace(v)))


def transform(distinct: DataFrame, model: Whitening) -> DataFrame:
    """``x, copies, deviation, whitened array<double>`` of every distinct vector, each worked out once."""
    n, sums, d = model.n, model.sums, len(model.sums)
    usable = model.usable
    scaled = model.components[:, usable] / np.sqrt(model.eigenvalues[usable])

    def run(batches):
        for b in batches:
            y = from_mean(matrix(b.column(0), d), n, sums)
            small = y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * d < _EXACT
            squared = (y * y if small else y.astype(object) ** 2).sum(axis=1).tolist()
            out = np.full((len(y), len(usable)), np.nan)
            out[:, usable] = (y.astype(float) / n) @ scaled
            yield pa.record_batch(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([s if s < 1 << 63 else None for s in squared], pa.int64()),
                    pa.array(list(out), pa.list_(pa.float64())),
                ],
                names=["x", "copies", "deviation", "whitened"],
            )

    return distinct.select("x", "copies").mapInArrow(run, "x array<long>, copies long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """The largest entry in size of the whitened vectors' covariance minus the identity."""
    usable = model.usable
    k = int(usable.sum())
    if not k:
        return None
    n, wide = model.n, len(usable)
    means = whitened.agg(*(F.sum(F.col("whitened")[int(j)] * F.col("copies")) / n for j in np.flatnonzero(usable))).first()
    mean = np.array(means, dtype=float)
    kept = whitened.select(F.slice("whitened", 1, wide).alias("whitened"), "copies")

    def centred(y: np.ndarray) -> np.ndarray:
        out = np.zeros_like(y)
        out[:, usable] = y[:, usable] - mean
        return out

    c = covariance(kept, "whitened", wide, n, centred)[np.ix_(usable, usable)]
    return float(np.abs(c - np.eye(k)).max())


def whiten(rows: DataFrame, whitened: DataFrame, n: int) -> DataFrame:
    """``vec_id, deviation, whitened`` of every row, joined back on its vector; hot vectors are salted."""
    hot = whitened.where((F.col("copies") >= HOT_ROWS) & (F.col("copies") * 1000 > n)).select(F.xxhash64("x").alias("h"))
    hashes = [r["h"] for r in hot.collect()]  # fewer than 1,000
    is_hot = F.xxhash64("x").isin(hashes) if hashes else F.lit(False)
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = whitened.select("x", F.explode(salts).alias("salt"), "deviation", "whitened")
    # Any salt finds the same result, so a task that runs again may deal its rows anew.
    salt = F.when(is_hot, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    return rows.withColumn("salt", salt).join(copies, ["x", "salt"]).select("vec_id", "deviation", "whitened")


def whitening_report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component."""
    rows = integer_vectors(vectors)
    distinct = distinct_vectors(rows)
    model = fit(distinct, components)
    if model is None:
        none = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], none)
    whitened = reuse_checkpointed(transform(distinct, model))
    error = identity_error(whitened, model)
    shares = F.array(*(F.lit(float(e / model.trace) if model.trace > 0 else None).cast("double") for e in model.eigenvalues))
    return (
        whiten(rows, whitened, model.n)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            F.nanvl("value", F.lit(None).cast("double")).alias("whitened"),
            shares[F.col("at")].alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
        )
    )
