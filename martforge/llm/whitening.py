"""Embedding whitening by a covariance that is weighted with multiplicities.

Rows become integer vectors x.  Identical x vectors are grouped, counted
map-side; what follows runs over distinct vectors only:

1. n and the exact sums S, in integers, weighted by the counts;
2. the covariance: every task centres its vectors ((n * x - S) / n, an integer
   difference, so nothing cancels) and multiplies Y' diag(w) Y in one GEMM a
   batch.  A task's matrix is added up row by row in a shuffle;
3. the eigenvectors of that one d x d matrix, on the driver: its size depends
   on the dimension, not on the rows;
4. each distinct vector is whitened once, and joined back to the rows by a
   128-bit hash of x (by x itself if two vectors share a hash).

Weights are the counts (the covariance over all rows) or one (over distinct
vectors).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martforge.llm.common import Scratch, join_counted, read

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: beyond it a double has no fraction left and a long soon ends: larger entries are cut to it
LARGEST = float(2**52)
#: an eigenvalue below this share of the largest is rounding noise: there is nothing to whiten
NOISE = 1e-12
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def hashes(x: Column) -> Column:
    """A 128-bit hash of a vector, as two longs."""
    return F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))


def vectors(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """(vec_id, x array<long>) of the rows whose vector is neither null nor holds a null or non-finite entry."""
    c = F.transform(F.col(vector), lambda v: v.cast("double"))
    fine = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    scaled = F.transform("c", lambda v: F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), v * SCALE))) + SHIFT)
    return (rows.select(F.col(key).cast("long").alias("vec_id"), c.alias("c"))
            .filter(F.col("c").isNotNull() & (F.size("c") > 0)).filter(fine).select("vec_id", scaled.alias("x")))


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(d, row numbers, integer matrix) for every length of vector in the batch."""
    x = batch.column("x")
    size = np.asarray(x.value_lengths(), np.int64)
    values = np.asarray(x.flatten(), np.int64)
    ends = np.cumsum(size)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield int(d), at, values[(ends[at] - d)[:, None] + np.arange(d)[None, :]]


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("w"), np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, dim, total): a task's weighted sums; dim -1 holds the weights.  Exact: integers that would pass 64 bits are Python's."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        w = _weights(batch)
        for d, at, x in _by_dimension(batch):
            some = w[at]
            wide = float(np.abs(x).max()) * float(some.sum()) >= 2**62
            part = (x.astype(object) * some.astype(object)[:, None]).sum(0) if wide else (x * some[:, None]).sum(0).astype(object)
            part = np.append(part, int(some.sum()))
            total[d] = total[d] + part if d in total else part
    rows = [(d, i if i < d else -1, str(int(v))) for d, all_ in total.items() for i, v in enumerate(all_)]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                          pa.array([r[2] for r in rows], pa.string())], names=["d", "dim", "total"])


@dataclass
class Moments:
    """n and the exact sums of one dimension; ``centred`` gives n * x - S, exact, as int64 if that holds it."""

    n: int
    s: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        widest = max(float(self.n) * float(np.abs(x).max(initial=0)), max(abs(float(v)) for v in self.s))
        if widest < 2**61:
            return x * np.int64(self.n) - np.asarray(self.s, np.int64)[None, :]
        return x.astype(object) * self.n - np.asarray(self.s, object)[None, :]


def _products(moments: dict[int, Moments]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(d, i, row): a task's rows of Y' diag(w) Y."""
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            w = _weights(batch)
            for d, at, x in _by_dimension(batch):
                y = moments[d].centred(x).astype(np.float64) / moments[d].n
                part = y.T @ (y * w[at, None].astype(np.float64))
                total[d] = total[d] + part if d in total else part
        for d, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()),
                                              pa.array([r.tobytes() for r in m], pa.binary())], names=["d", "i", "row"])
    return run


def _add_rows(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(key[0].as_py())
    for batch in batches:
        for row in batch.column("row"):
            total += np.frombuffer(row.as_py())
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                                      pa.array([total.tobytes()], pa.binary())], names=["d", "i", "row"])


@dataclass
class Model:
    """What whitens vectors of one dimension: at most ``COMPONENTS`` unit eigenvectors and their eigenvalues."""

    moments: Moments
    vectors: np.ndarray  # d x k
    values: np.ndarray  # k, falling
    trace: float

    @classmethod
    def of(cls, moments: Moments, covariance: np.ndarray, components: int) -> "Model":
        e, v = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(e)[::-1][:components]
        e, v = e[order], v[:, order]
        v = v * np.where(v[np.abs(v).argmax(0), np.arange(v.shape[1])] < 0, -1.0, 1.0)  # the largest entry is positive
        e = np.where(e > NOISE * max(e[0], 0.0), e, 0.0)
        return cls(moments, np.ascontiguousarray(v), e, float(np.trace(covariance)))

    def explained(self) -> list[float]:
        return [float(v / self.trace) if self.trace > 0 else 0.0 for v in self.values]

    def whiten(self, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """The exact deviations (None beyond a long) and the whitened values (NaN where the eigenvalue is 0)."""
        num = self.moments.centred(x)
        sure = num.dtype != object and float(np.abs(num).max(initial=0)) ** 2 * num.shape[1] < 2**62
        if sure:
            deviation = (num * num).sum(1).tolist()
        else:
            exact = (num.astype(object) ** 2).sum(1)
            deviation = [int(v) if v < 2**63 else None for v in exact]
        root = np.sqrt(np.where(self.values > 0, self.values, np.nan))
        return deviation, (num.astype(np.float64) / self.moments.n) @ self.vectors / root


def _whiten(models: dict[int, Model]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation: list = [None] * batch.num_rows
            white: list = [None] * batch.num_rows
            for d, at, x in _by_dimension(batch):
                dev, w = models[d].whiten(x)
                for k, row in enumerate(at):
                    deviation[row], white[row] = dev[k], w[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("x", "h", "w", "d", "copies")] + [pa.array(deviation, pa.int64()), pa.array(white, pa.list_(pa.float64()))],
                names=["x", "h", "w", "d", "copies", "deviation", "white"])
    return run


def fit(distinct: DataFrame, components: int) -> dict[int, Model]:
    """A model for every dimension among the distinct vectors (x, w)."""
    some = distinct.select("x", "w")
    sums = some.mapInArrow(_sums, "d int, dim int, total string")
    exact = sums.groupBy("d", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # d + 1 rows a dimension
    found: dict[int, dict[int, int]] = {}
    for r in exact:
        found.setdefault(r["d"], {})[r["dim"]] = int(r["total"])
    moments = {d: Moments(by[-1], [by[i] for i in range(d)]) for d, by in found.items()}
    if not moments:
        return {}
    rows = some.mapInArrow(_products(moments), "d int, i int, row binary").groupBy("d", "i").applyInArrow(_add_rows, "d int, i int, row binary")
    matrix: dict[int, dict[int, np.ndarray]] = {}
    for r in rows.toLocalIterator():  # d rows a dimension
        matrix.setdefault(r["d"], {})[r["i"]] = np.frombuffer(r["row"])
    return {d: Model.of(moments[d], np.stack([by[i] for i in range(d)]) / moments[d].n, components) for d, by in matrix.items()}


def _identity_errors(white: DataFrame, models: dict[int, Model], components: int) -> dict[int, float]:
    """Largest absolute entry of the whitened values' covariance minus the identity, measured over what was whitened."""
    value = lambda i: F.nanvl(F.coalesce(F.get("white", i), F.lit(0.0)), F.lit(0.0))
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    sums = [F.sum(F.col("w") * value(i)).alias(f"m{i}") for i in range(components)]
    sums += [F.sum(F.col("w") * value(i) * value(j)).alias(f"p{i}_{j}") for i, j in pairs]
    out = {}
    for r in white.groupBy("d").agg(*sums).collect():  # one row a dimension
        model = models[r["d"]]
        live = [i for i, e in enumerate(model.values) if e > 0]
        n = model.moments.n
        gaps = [abs(r[f"p{i}_{j}"] / n - r[f"m{i}"] / n * (r[f"m{j}"] / n) - (i == j)) for i, j in pairs if i in live and j in live]
        out[r["d"]] = max(gaps, default=0.0)
    return out


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS, by_count: bool = True,
           digest: Callable[[Column], Column] = hashes) -> DataFrame:
    """Per remaining row and component: (vec_id, component, n, deviation, whitened, explained, identity_error).

    * rows whose vector is null, empty, or holds a null or non-finite entry go;
      entries beyond 2**52 / 1024 are cut to that;
    * vectors of different lengths are fitted apart, each length on its own rows;
    * a vector has min(``components``, its length) rows; where the eigenvalue is
      0 (fewer independent vectors than components) ``whitened`` is null and
      ``explained`` 0;
    * ``deviation`` is null if it does not fit a long;
    * repeated and null ids are rows like others; further columns are not read;
    * ``by_count``: every copy weighs in the fit, else every distinct vector once."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "whitening")
    kept = vectors(rows, vector, key)
    distinct = kept.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    distinct = scratch.save(distinct.select("x", digest(F.col("x")).alias("h"), (F.col("copies") if by_count else F.lit(1).cast("long")).alias("w"),
                                            F.size("x").alias("d"), "copies"), "distinct")
    models = fit(distinct, components)
    if not models:
        return spark.createDataFrame([], OUT)
    hash_type = distinct.schema["h"].dataType.simpleString()
    white = distinct.mapInArrow(_whiten(models), f"x array<long>, h {hash_type}, w long, d int, copies long, deviation long, white array<double>")
    white = scratch.save(white, "white")
    errors = _identity_errors(white, models, components)
    clash = white.groupBy("h").agg(F.count(F.lit(1)).alias("n_x")).filter("n_x > 1")
    by = "h" if clash.isEmpty() else "x"
    total = white.agg(F.sum("copies")).first()[0]
    joined = join_counted(kept.select("vec_id", digest(F.col("x")).alias("h") if by == "h" else "x"),
                          white.select(by, "copies", "d", "deviation", "white"), [by], "copies", total, "inner")
    figures = spark.createDataFrame([(d, m.moments.n, m.explained(), errors[d]) for d, m in models.items()],
                                    "d int, n long, explained array<double>, identity_error double")  # one row a dimension
    out = joined.join(F.broadcast(figures), "d").select(
        "vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("white", "explained")).alias("at", "c"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
                      F.when(~F.isnan("c.white"), F.col("c.white")).alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
