"""Embedding whitening: exact moments in Spark, principal components by FEAST.

Entries become integers x = floor(SCALE * c) + OFFSET.  A first pass sums them by
dimension, a second sums the products of what is left after an integer near
the mean is taken off; all sums are of integers, so they do not depend on the order
of tasks, and the covariance (divisor n) is their exact quotient rounded once.
Its greatest eigenpairs come from :mod:`.feast`.  A third pass measures the
whitened vectors' covariance, a fourth writes them.  Tasks hold one Arrow batch and
one matrix of the dimension's order; what reaches the driver are the sums,
at most ``feast.MAX_ORDER`` squared numbers.

Rows are left out whose vector is null, holds null or non-finite entries or
entries whose integers pass 2 ** 62 in size, or has not the table's dimension:
the length that most of the other rows have (the greater on a tie).  Components whose
eigenvalue is not over ``FLOOR`` of the greatest are noise of a singular
covariance and are not returned, so a table of one vector, or of copies
of one, gives rows without components.  An empty table gives no rows.  Null and
repeated ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import feast

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Share of the greatest eigenvalue that a component must have.
FLOOR = 1e-10
_LIMIT = float(1 << 62)
_LOW = (1 << 32) - 1


def _integers(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows remain, and their entries as integers, a row each."""
    at = np.flatnonzero(pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False) == dims)
    c = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dims)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * c) + OFFSET
    ok = (np.abs(x) < _LIMIT).all(1)  # false for NaN too
    return at[ok], x[ok].astype(np.int64)


@dataclass
class Moments:
    """Rows, dimension, and by dimension the sums, an integer near the mean, and the greatest distance from it."""

    n: int
    dims: int
    sums: list[int]
    centre: np.ndarray
    reach: int

    @property
    def rest(self) -> list[int]:
        """n times (mean - centre), exactly."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.centre)]


def _vectors(df: DataFrame, vector_col: str, *more: str) -> DataFrame:
    return df.select(F.col(vector_col).cast("array<double>").alias("_vector"), *more)


def moments(df: DataFrame, vector_col: str = "embedding") -> Moments:
    """First pass: counts, sums and ranges of every dimension."""
    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            lengths = pc.list_value_length(batch.column(0)).drop_null().unique().to_pylist()
            for d in lengths:
                _, x = _integers(batch.column(0), d)
                if not len(x):
                    continue
                new = [len(x), (x >> 32).sum(0), (x & _LOW).sum(0), x.min(0), x.max(0)]
                old = total.get(d)
                total[d] = new if old is None else [old[0] + new[0], old[1] + new[1], old[2] + new[2],
                                                    np.minimum(old[3], new[3]), np.maximum(old[4], new[4])]
        for d, (n, high, low, least, most) in total.items():
            # An empty vector has no dimension; one row keeps its count.
            k = max(d, 1)
            pad = lambda v: v if d else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, d, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, n, np.int64)),
                 *[pa.array(pad(v).astype(np.int64)) for v in (high, low, least, most)]],
                names=["d", "j", "n", "high", "low", "least", "most"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = (_vectors(df, vector_col).mapInArrow(one, "d int, j int, n long, high long, low long, least long, most long")
            .groupBy("d", "j").agg(F.sum("n").alias("n"), exact("high"), exact("low"), F.min("least").alias("least"), F.max("most").alias("most")))
    # At most one length wins; lengths with fewer rows stay in Spark.
    best = rows.groupBy("d").agg(F.max("n").alias("n")).orderBy(F.col("n").desc(), F.col("d").desc()).first()
    if best is None or not best.d:
        return Moments(0 if best is None else best.n, 0, [], np.empty(0, np.int64), 0)
    if best.d > feast.MAX_ORDER:
        raise ValueError(f"vectors have {best.d} entries, more than {feast.MAX_ORDER}")
    got = sorted(rows.where(F.col("d") == best.d).collect(), key=lambda r: r.j)
    sums = [(int(r.high) << 32) + int(r.low) for r in got]
    centre = [s // best.n for s in sums]
    reach = max(max(r.most - m, m - r.least) for r, m in zip(got, centre))
    return Moments(best.n, best.d, sums, np.array(centre, np.int64), reach)


def _products(y: np.ndarray, reach: int) -> np.ndarray:
    """Y'Y: in doubles where these hold the sums exactly, else in chunks that they hold."""
    step = max(1, (1 << 53) // max(1, reach * reach))
    total = np.zeros((y.shape[1], y.shape[1]), np.int64)
    for k in range(0, len(y), step):
        part = y[k:k + step].astype(np.float64)
        total += np.rint(part.T @ part).astype(np.int64)
    return total


def covariance(df: DataFrame, m: Moments, vector_col: str = "embedding") -> np.ndarray:
    """Second pass: the covariance of the integers, rounded once.

    Where entries are so far apart that their products leave a long, the sums are
    of doubles instead.
    """
    d, centre, reach = m.dims, m.centre, m.reach
    whole = m.n * reach * reach < 1 << 62 and reach < 1 << 26
    upper = np.triu_indices(d)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), np.int64 if whole else np.float64)
        for batch in batches:
            _, x = _integers(batch.column(0), d)
            y = x - centre
            total += _products(y, reach) if whole else y.astype(np.float64).T @ y.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)),
                                          pa.array(total[upper])], names=["i", "j", "v"])

    rows = (_vectors(df, vector_col).mapInArrow(one, f"i int, j int, v {'long' if whole else 'double'}")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow())
    rest, v = m.rest, np.zeros((d, d))
    for i, j, s in zip(*(rows.column(k).to_pylist() for k in range(3))):
        v[i, j] = v[j, i] = (m.n * s - rest[i] * rest[j]) / (m.n * m.n)
    return v


@dataclass
class Model:
    """Moments, components as columns (falling eigenvalues), and the trace of the covariance."""

    moments: Moments
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        """Each component's share of the trace."""
        return [float(e) / self.trace for e in self.values]


def fit(df: DataFrame, *, vector_col: str = "embedding", components: int = COMPONENTS) -> Model:
    """Mean and principal components of all remaining vectors."""
    m = moments(df, vector_col)
    if not m.n or not m.dims:
        return Model(m, np.empty(0), np.empty((m.dims, 0)), 0.0)
    v = covariance(df, m, vector_col)
    top = float(np.abs(v).sum(1).max())
    values, vectors = feast.largest(df.sparkSession, v, components, FLOOR * top) if top else (np.empty(0), np.empty((m.dims, 0)))
    return Model(m, values, vectors, float(np.trace(v)))


def whiten(df: DataFrame, model: Model, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, deviation (exact sum of squares of n x - S) and whitened (an entry
    per component) of every remaining row."""
    m, d, n = model.moments, model.moments.dims, model.moments.n
    turn = model.vectors / np.sqrt(model.values) if len(model.values) else model.vectors
    rest = m.rest
    # n y - rest stays a long together with its squares' sum, else Python's integers do it.
    most = n * m.reach + max((abs(r) for r in rest), default=0)
    small = d * most * most < 1 << 62
    centre, shift = m.centre, np.array([r / n for r in rest]) if n else np.empty(0)
    schema = df.select(id_col, F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _integers(batch.column(0), d)
            y = x - centre
            if small:
                deviation = pa.array(((n * y - np.array(rest, np.int64)) ** 2).sum(1), pa.int64()).cast(pa.decimal128(38, 0))
            else:
                exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest)) for row in y.tolist()]
                deviation = pa.array([x if x < 10 ** 38 else None for x in exact], pa.decimal128(38, 0))
            z = (y - shift) @ turn
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(at)), deviation, lists], names=[id_col, "deviation", "whitened"])

    return _vectors(df, vector_col, id_col).where(F.col("_vector").isNotNull()).mapInArrow(one, schema)


def identity_error(whitened: DataFrame, components: int) -> float:
    """Third pass: greatest entry, in size, of the whitened vectors' covariance minus the identity."""
    if not components:
        return 0.0
    k = components

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((k + 1, k))
        for batch in batches:
            z = batch.column(0).flatten().to_numpy().reshape(-1, k)
            n += len(z)
            total += np.vstack([z.T @ z, z.sum(0)])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)),
                                          pa.array(total.ravel()), pa.array(np.full(total.size, n, np.int64))], names=["i", "j", "v", "n"])

    rows = whitened.select("whitened").mapInArrow(one, "i int, j int, v double, n long").groupBy("i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect()
    total, n = np.zeros((k + 1, k)), 0
    for r in rows:
        total[r.i, r.j], n = r.v, r.n
    mean = total[k] / n
    return float(np.abs(total[:k] / n - np.outer(mean, mean) - np.eye(k)).max())


def components(df: DataFrame, model: Model, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, component (from 1), n, deviation, whitened, explained and
    identity_error: a row for every remaining row and component."""
    rows = whiten(df, model, id_col=id_col, vector_col=vector_col)
    error = identity_error(rows, len(model.values))
    share = F.array(*[F.lit(x) for x in model.explained]).cast("array<double>")
    return rows.select(id_col, "deviation", F.posexplode("whitened").alias("_k", "whitened")).select(
        id_col, (F.col("_k") + 1).alias("component"), F.lit(model.moments.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("_k")).alias("explained"), F.lit(error).alias("identity_error"))
