"""Mergeable moments (G3, X3, L3-L5): count, means and co-moments per batch,
from which statistics, covariances and principal components of any span follow.

A partial is one row: n, the means and the sums of products of deviations
(upper triangle).  Partials add up exactly (Chan, Golub and LeVeque, 1983):
C = sum C_b + sum n_b (m_b - m)(m_b - m)', so a span is folded without its rows
and without the cancellation of raw sums.  Rows with a null in any column are
left out, as the feature assembler does.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.functions.columns import dbl

#: Values of the keys that a task holds before it hands on what it has.
HELD = 4096


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def _folded(a: tuple | None, b: tuple) -> tuple:
    """(n, means, co-moments) of two sets of rows together."""
    if a is None:
        return b
    n, d = a[0] + b[0], b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


def _by_key(batch: pa.RecordBatch, k: int, x: np.ndarray) -> Iterator[tuple[tuple, np.ndarray]]:
    """The rows of each value of the first ``k`` columns."""
    if not k:
        yield (), x
        return
    code = np.zeros(len(x), np.int64)
    for i in range(k):
        coded = batch.column(i).dictionary_encode(null_encoding="encode")
        code = code * len(coded.dictionary) + coded.indices.to_numpy()
        code = np.unique(code, return_inverse=True)[1]          # stays below the number of rows
    order = np.argsort(code, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
        yield tuple(batch.column(i)[int(rows[0])].as_py() for i in range(k)), x[rows]


def partial_moments(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, mean, comoment): one row for each value of ``keys``.

    Each task folds its batches, one matrix product each, and sends one row for
    each value of the keys that it has met.
    """
    k, m = len(cols), len(keys)
    x = df.select(*keys, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    x = x.dropna(subset=[f"x{i}" for i in range(k)])
    upper = np.triu_indices(k)                                  # the order of _pairs

    def out(held: dict[tuple, tuple], types: list[pa.DataType]) -> pa.RecordBatch:
        found = list(held.values())
        return pa.RecordBatch.from_arrays(
            [pa.array([key[i] for key in held], t) for i, t in enumerate(types)]
            + [pa.array([n for n, _, _ in found], pa.int64()),
               pa.array([v.tolist() for _, v, _ in found], pa.list_(pa.float64())),
               pa.array([c[upper].tolist() for _, _, c in found], pa.list_(pa.float64()))],
            names=[*(f"k{i}" for i in range(m)), "n", "mean", "comoment"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        types: list[pa.DataType] = []
        for batch in batches:
            if not len(batch):
                continue
            types = [batch.column(i).type for i in range(m)]
            values = np.column_stack([batch.column(m + i).to_numpy() for i in range(k)])
            for key, rows in _by_key(batch, m, values):
                mean = rows.mean(0)
                d = rows - mean
                held[key] = _folded(held.get(key), (len(rows), mean, d.T @ d))
            if len(held) > HELD:
                yield out(held, types)
                held.clear()
        if held:
            yield out(held, types)

    def fold(table: pa.Table) -> pa.Table:
        total = None
        for r in table.select(["n", "mean", "comoment"]).to_pylist():
            c = np.zeros((k, k))
            c[upper] = r["comoment"]
            total = _folded(total, (r["n"], np.array(r["mean"]), c))
        key = tuple(table.column(i)[0].as_py() for i in range(m))
        return pa.Table.from_batches([out({key: total}, [table.column(i).type for i in range(m)])])
    fields = "".join(f"`k{i}` {df.select(key).schema[0].dataType.simpleString()}, "
                     for i, key in enumerate(keys))
    schema = fields + "n long, mean array<double>, comoment array<double>"
    rows = x.mapInArrow(partial, schema)
    whole = rows.groupBy(*[f"k{i}" for i in range(m)]).applyInArrow(fold, schema)
    names = [df.select(key).columns[0] for key in keys]
    return whole.select(*[F.col(f"k{i}").alias(n) for i, n in enumerate(names)],
                        "n", "mean", "comoment")


def merge_moments(partials: DataFrame, k: int, keys: Sequence[str] = ()) -> DataFrame:
    """Partials folded to one row for each value of ``keys``, in the same form."""
    key = list(keys) or ["_all"]
    p = partials if keys else partials.withColumn("_all", F.lit(1))
    n = F.sum("n")
    means = p.groupBy(*key).agg(F.array(*[
        F.sum(F.col("n") * F.col("mean")[i]) / n for i in range(k)]).alias("_m"))
    p = p.join(means, key)
    off = F.zip_with("mean", "_m", lambda a, b: a - b)
    p = p.withColumn("_d", off)
    g = p.groupBy(*key).agg(n.alias("n"), F.first("_m").alias("mean"), F.array(*[
        F.sum(F.col("comoment")[at] + F.col("n") * F.col("_d")[i] * F.col("_d")[j])
        for at, (i, j) in enumerate(_pairs(k))]).alias("comoment"))
    return g.select(*keys, "n", "mean", "comoment")


def covariances(moments: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, a, b, n, mean_a, mean_b, cov): sample covariances of all pairs a <= b."""
    rows = F.array(*[F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), F.col("n"),
                              F.col("mean")[i].alias("mean_a"), F.col("mean")[j].alias("mean_b"),
                              F.when(F.col("n") > 1, F.col("comoment")[at] / (F.col("n") - 1))
                              .alias("cov")) for at, (i, j) in enumerate(_pairs(len(cols)))])
    return moments.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def principal_components(moments: DataFrame, cols: Sequence[str],
                         target_variance: float | None = None, share: float = 0.33):
    """(scale, loadings, explained) of standardised columns from one row of
    moments, all that reaches the driver.

    As many components as reach ``target_variance`` of the whole, or, without a
    target, max(1, int(share * columns)).  A component's largest loading is positive.
    """
    k = len(cols)
    row = moments.select("n", "mean", "comoment").first()
    c = np.zeros((k, k))
    if row is not None and row["n"] > 1:
        for (i, j), v in zip(_pairs(k), row["comoment"]):
            c[i, j] = c[j, i] = v / (row["n"] - 1)
    mean = np.array(row["mean"]) if row is not None else np.zeros(k)
    std = np.sqrt(np.diag(c))
    inverse = np.where(std > 0, 1 / np.where(std > 0, std, 1), 0.0)
    values, vectors = np.linalg.eigh(c * np.outer(inverse, inverse))
    order = np.argsort(-values, kind="stable")
    values, vectors = np.clip(values[order], 0, None), vectors[:, order]
    explained = values / values.sum() if values.sum() > 0 else values
    if target_variance is None:
        width = max(1, int(k * share))
    else:
        width = min(k, int(np.searchsorted(np.cumsum(explained), target_variance - 1e-12)) + 1)
    vectors = vectors[:, :width]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(width)])
    return (mean, inverse), vectors, explained[:width]


def project(df: DataFrame, cols: Sequence[str], scale, loadings: np.ndarray,
            prefix: str = "pc") -> DataFrame:
    """``df`` with the components of each row (null where a column is null)."""
    mean, inverse = scale

    def component(j: int) -> Column:
        total = dbl(0)
        for c, m, s, w in zip(cols, mean, inverse, loadings[:, j]):
            total = total + (F.col(c).cast("double") - dbl(float(m))) * dbl(float(s * w))
        return total.alias(f"{prefix}{j + 1}")
    return df.select("*", *[component(j) for j in range(loadings.shape[1])])


def explained_table(spark: SparkSession, explained: np.ndarray, target: float) -> DataFrame:
    total = np.cumsum(explained).tolist()
    rows = [(i + 1, float(e), total[i], total[i] >= target - 1e-12)
            for i, e in enumerate(explained)]
    return spark.createDataFrame(rows, "component int, explained_variance double, "
                                       "cumulative double, reaches_target boolean")
