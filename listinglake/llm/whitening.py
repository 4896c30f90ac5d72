"""Embedding whitening (operator 11) with a weighted multiplicity covariance.

Entries are taken to a grid, x = floor(``SCALE`` * entry) + ``OFFSET``, and identical x vectors are
grouped once. The group's weight in the fit is one or its number of rows. Sums, then the centred
weighted cross products (one GEMM per Arrow batch, added up per task and then by entry of the matrix)
come from the groups; the driver sees d sums and d * (d + 1) / 2 entries, whatever the number of rows.
Every distinct vector is whitened once, and the rows take its values by a join on two independent
64-bit hashes of x, so that no row's vector is shuffled twice.

Defined results: rows whose vector is null, empty or holds a null or non-finite entry are left out;
so are vectors of another length than the commonest (of ties the longest), as they have no covariance
with the others; entries beyond +-``REACH`` / ``SCALE`` count as that; components whose eigenvalue is
below ``LEAST`` of the largest (a constant dimension, fewer vectors than dimensions) cannot be scaled
to variance one and are left out, so fewer than two distinct vectors give no rows; repeated rows and
null vec_ids come back as often as they are given; a deviation beyond a long is null; an empty table
gives no rows; other columns are never read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, stored

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
REACH, LEAST = float(1 << 40), 1e-12


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def on_grid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, x: the rows with a usable vector."""
    entries = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), entries.alias("v")).filter(
        (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(REACH)), F.lit(-REACH))).cast("bigint") + OFFSET)
    return rows.select("vec_id", x.alias("x"))


def sums(groups: DataFrame, column: str, width: int, kind: str) -> list:
    """Weighted sum of every position of an array column: exact for integers."""
    def run(batches):
        total = None
        for b in batches:
            m, w = _matrix(b.column("m"), width), b.column("weight").to_numpy(zero_copy_only=False)
            if kind != "double":  # |x| < 2^41 and a batch's weights may be large: Python integers where they could overflow
                exact = float(w.sum()) * float(np.abs(m).max(initial=0)) < 2.0 ** 62
                part = (w @ m).astype(object) if exact else (w.astype(object)[:, None] * m.astype(object)).sum(axis=0)
            else:
                part = (w[:, None] * m).sum(axis=0)
            total = part if total is None else total + part
        if total is not None:
            values = [float(v) if kind == "double" else str(v) for v in total]
            yield pa.RecordBatch.from_pydict({"j": pa.array(range(width), pa.int32()), "s": values})

    rows = groups.select("weight", F.col(column).alias("m")).mapInArrow(run, f"j int, s {'double' if kind == 'double' else 'string'}")
    found = rows.groupBy("j").agg(F.sum(F.col("s").cast(kind)).alias("s")).collect()  # one row for each dimension
    out = dict(found)
    return [out[j] for j in range(width)]


def covariance(groups: DataFrame, column: str, width: int, total: list, n: int) -> np.ndarray:
    """Weighted covariance, divisor n, of an array column whose weighted sums are ``total``."""
    centre = _Centre(total, n)

    def run(batches):
        gram = np.zeros((width, width))
        for b in batches:
            y = centre(_matrix(b.column("m"), width))
            gram += (y * b.column("weight").to_numpy(zero_copy_only=False)[:, None]).T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": gram[i, j]})

    rows = groups.select("weight", F.col(column).alias("m")).mapInArrow(run, "i int, j int, v double")
    found = rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # d * (d + 1) / 2 rows
    out = np.zeros((width, width))
    for i, j, v in found:
        out[i, j] = out[j, i] = v / n
    return out


class _Centre:
    """x - S / n: for integers from the exact n * x - S wherever that fits 64 bits."""

    def __init__(self, total: list, n: int):
        self.n = n
        self.exact = all(int(t) == t for t in total) and not any(isinstance(t, float) for t in total)
        self.total = [int(t) for t in total] if self.exact else np.array(total, np.float64)
        self.mean = np.array([float(Fraction(t) / n) for t in self.total])
        self.most = max((abs(t) for t in self.total), default=0)

    def scaled(self, m: np.ndarray) -> np.ndarray:
        """n * x - S: int64, or Python integers where int64 could overflow."""
        if self.n * int(np.abs(m).max(initial=0)) + self.most < 1 << 62:
            return m * self.n - np.array(self.total, np.int64)
        return m.astype(object) * self.n - np.array(self.total, object)

    def __call__(self, m: np.ndarray) -> np.ndarray:
        if not self.exact:
            return m - self.mean
        return (self.scaled(m) / self.n).astype(np.float64)

    def deviation(self, m: np.ndarray) -> pa.Array:
        far = self.scaled(m)
        if far.dtype == object or float(np.abs(far).max(initial=0)) ** 2 * m.shape[1] >= 2.0 ** 62:
            far = far.astype(object)
            return pa.array([v if v < 1 << 63 else None for v in (far * far).sum(axis=1)], pa.int64())
        return pa.array((far * far).sum(axis=1), pa.int64())


def principal(cov: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns; the largest entry positive)."""
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = np.flatnonzero((values > 0) & (values > LEAST * values[0]))[:most]
    values, vectors = values[keep], vectors[:, keep]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
    return values, vectors * sign


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           weights: str = "one") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, copies for every usable row and
    component. ``weights``: 'one' fits on every distinct x vector once, 'count' as often as it occurs."""
    if weights not in ("one", "count"):
        raise ValueError(f"weights: {weights}")
    id_type = vectors.select(id_col).schema[0].dataType.simpleString()
    rows = on_grid(vectors, id_col, vector_col)
    widths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    nothing = rows.sparkSession.createDataFrame([], f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, "
                                                "explained double, identity_error double, copies bigint")
    if not widths:
        return nothing
    width = widths[0]["d"]
    rows = rows.filter(F.size("x") == width)
    # the second hash starts from a seed of its own
    key = [F.xxhash64("x").alias("h1"), F.xxhash64(F.lit("second"), F.col("x")).alias("h2")]
    groups = rows.groupBy("x").agg(F.count("*").alias("copies"))
    weight = F.lit(1).cast("bigint") if weights == "one" else F.col("copies")
    groups = stored(groups.select(*key, "x", "copies", weight.alias("weight")), "whitening-groups")
    n = groups.agg(F.sum("weight")).first()[0]
    total = sums(groups, "x", width, "decimal(38,0)")
    values, axes = principal(cov := covariance(groups, "x", width, total, n), components)
    k = len(values)
    if not k:
        return nothing
    centre, scale = _Centre(total, n), axes / np.sqrt(values)

    def batch(b: pa.RecordBatch) -> dict:
        m = _matrix(b.column("x"), width)
        z = np.ascontiguousarray(centre(m) @ scale)
        offsets = pa.array(np.arange(0, z.size + 1, k), pa.int32())
        return {"h1": b.column("h1"), "h2": b.column("h2"), "copies": b.column("copies"), "weight": b.column("weight"),
                "deviation": centre.deviation(m), "z": pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))}

    white = stored(mapped(groups, batch, "h1 bigint, h2 bigint, copies bigint, weight bigint, deviation bigint, z array<double>", rows=4096),
                   "whitened")
    error = np.abs(covariance(white, "z", k, sums(white, "z", k, "double"), n) - np.eye(k)).max()
    explained = F.array(*[F.lit(float(e / np.trace(cov))) for e in values])
    out = rows.select("vec_id", *key).join(white.select("h1", "h2", "deviation", "copies", "z"), ["h1", "h2"])
    out = out.select("vec_id", "deviation", "copies", F.posexplode("z").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(int(n)).cast("bigint").alias("n"), "deviation", "whitened",
                      F.get(explained, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"), "copies")
