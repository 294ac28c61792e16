"""Correlation matrix and correlation-matrix principal components
(A1, O1-O3, M1).

The correlation matrix (A1) comes from ``pyspark.ml.stat.Correlation``;
components (M1) from ``StandardScaler`` (unit deviation, no centring) and
``PCA``, whose covariance of the scaled rows is exactly the correlation
matrix. Both are distributed tree aggregates; only d x d results live on
the driver, so the driver cost depends on d, not on the row count. Rows
are projected by the fitted ``PCAModel`` (a JVM matrix-vector product).
Few features take one pass instead of three: every task sums up the products
of its rows around their mean, and the tasks' sums give that matrix; such rows
are projected by written-out products.

Projection is applied to the *uncentred, unscaled* rows, as the run this
library reproduces does; eigenvectors are those of the correlation matrix.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.ml.feature import PCA, PCAModel, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer

from tablefit.functions.vectors import to_vector

SIGN_EPS = 1e-9
#: Features at most whose components come from one pass, and whose projection is
#: written out.
FEW_FEATURES = 16


def correlation_matrix(df: DataFrame, features_col: str,
                       max_dim: int | None = None) -> np.ndarray:
    """A1: Pearson correlation of the vector (or array) column, d x d, with
    NaN (constant features) left in place. The matrix is on the driver;
    ``max_dim`` refuses wider inputs where the caller wants a bound."""
    col_type = df.schema[features_col].dataType
    src = df
    if isinstance(col_type, T.ArrayType):
        src = df.select(to_vector(F.col(features_col)).alias(features_col))
    first = src.select(F.col(features_col)).head()
    if first is None:
        raise ValueError("correlation of an empty table")
    d = first[0].size
    if max_dim is not None and d > max_dim:
        raise ValueError(f"{d} features is above the given width {max_dim}")
    m = Correlation.corr(src, features_col, "pearson").head()[0]
    return np.asarray(m.toArray(), dtype=float)


def correlation_long(spark: SparkSession, matrix: np.ndarray,
                     names: Sequence[str] | None = None, digits: int | None = 6) -> DataFrame:
    """Long form ``(i, j, feature_i, feature_j, corr)`` of a d x d matrix."""
    d = matrix.shape[0]
    names = list(names) if names is not None else [f"f{i}" for i in range(d)]
    rows = []
    for i in range(d):
        for j in range(d):
            v = float(matrix[i, j])
            v = None if np.isnan(v) else (round(v, digits) if digits is not None else v)
            rows.append((i, j, names[i], names[j], v))
    schema = T.StructType([
        T.StructField("i", T.IntegerType(), False), T.StructField("j", T.IntegerType(), False),
        T.StructField("feature_i", T.StringType(), False),
        T.StructField("feature_j", T.StringType(), False),
        T.StructField("corr", T.DoubleType(), True)])
    return spark.createDataFrame(rows, schema)


def sign_rule(vectors: np.ndarray, eps: float = SIGN_EPS) -> np.ndarray:
    """+1/-1 per column so that, after multiplying, the column's first
    loading with |v| > eps is positive (reproducible across solvers)."""
    signs = np.ones(vectors.shape[1])
    for j in range(vectors.shape[1]):
        col = vectors[:, j]
        idx = np.flatnonzero(np.abs(col) > eps)
        if idx.size and col[idx[0]] < 0:
            signs[j] = -1.0
    return signs


def fix_signs(vectors: np.ndarray, eps: float = SIGN_EPS) -> np.ndarray:
    return vectors * sign_rule(vectors, eps)


def components_for_confidence(ratios: Sequence[float], confidence: float) -> int:
    """O3: the smallest number of leading components whose explained
    ratios add up to more than ``confidence`` (all of them if none does)."""
    total = 0.0
    for k, r in enumerate(ratios, start=1):
        total += float(r)
        if total > confidence:
            return k
    return len(ratios)


@dataclass
class Components:
    names: list[str]
    eigenvalues: np.ndarray          # sorted by |value|, descending (O1)
    vectors: np.ndarray              # columns are components, sign-fixed
    k: int                           # components used for projection (O2)
    k_confidence: int                # components needed for the confidence
    confidence: float
    constant: list[str] = field(default_factory=list)
    model: PCAModel | None = None    # Spark PCA fitted on standardised rows
    signs: np.ndarray | None = None  # +1/-1 per component (sign rule)

    @property
    def ratios(self) -> np.ndarray:
        total = float(np.sum(np.abs(self.eigenvalues)))
        if total == 0.0:
            return np.zeros_like(self.eigenvalues)
        return np.abs(self.eigenvalues) / total

    def explained(self, spark: SparkSession, digits: int | None = 6) -> DataFrame:
        """``(component, eigenvalue, ratio, cumulative, selected)``."""
        ratios = self.ratios
        cum = np.cumsum(ratios)
        r = (lambda v: round(float(v), digits)) if digits is not None else float
        rows = [(j + 1, r(self.eigenvalues[j]), r(ratios[j]), r(cum[j]), j < self.k)
                for j in range(len(ratios))]
        schema = T.StructType([
            T.StructField("component", T.IntegerType(), False),
            T.StructField("eigenvalue", T.DoubleType(), False),
            T.StructField("ratio", T.DoubleType(), False),
            T.StructField("cumulative", T.DoubleType(), False),
            T.StructField("selected", T.BooleanType(), False)])
        return spark.createDataFrame(rows, schema)

    def loadings(self, spark: SparkSession, digits: int | None = 6) -> DataFrame:
        """``(component, feature, loading)`` of the selected components."""
        r = (lambda v: round(float(v), digits)) if digits is not None else float
        rows = [(j + 1, self.names[i], r(self.vectors[i, j]))
                for j in range(self.k) for i in range(len(self.names))]
        schema = T.StructType([
            T.StructField("component", T.IntegerType(), False),
            T.StructField("feature", T.StringType(), False),
            T.StructField("loading", T.DoubleType(), False)])
        return spark.createDataFrame(rows, schema)

    def transform(self, df: DataFrame, arr_col: str, out_col: str = "components") -> DataFrame:
        """Adds ``out_col`` (array of the k selected components) of the
        unscaled rows, with the sign rule applied: few products are written
        out, and compiled with what reads them; others are computed by the
        fitted Spark PCA model (a BLAS matrix-vector product per row)."""
        if len(self.names) <= FEW_FEATURES:
            x = F.col(arr_col)
            return df.withColumn(out_col, F.array(*[
                reduce(add, [x[i] * F.lit(float(v)) for i, v in enumerate(self.vectors[:, j])])
                for j in range(self.k)]))
        if self.model is None or self.signs is None:
            raise ValueError("components were not fitted")
        model = self.model.copy()
        model.setInputCol("_pca_in").setOutputCol("_pca_out")
        staged = df.withColumn("_pca_in", to_vector(F.col(arr_col)))
        out = model.transform(staged).withColumn(
            "_pca_arr", vector_to_array(F.col("_pca_out"), "float64"))
        arr = F.col("_pca_arr")
        comps = F.array(*[arr[j] * F.lit(float(self.signs[j])) for j in range(self.k)])
        return out.withColumn(out_col, comps).drop("_pca_in", "_pca_out", "_pca_arr")

    def project(self, df: DataFrame, arr_col: str, keep: Sequence[str] = (),
                prefix: str = "Comp") -> DataFrame:
        """Rows -> ``keep..., Comp1..Compk`` (S8 layout)."""
        t = self.transform(df, arr_col, "_comps")
        return t.select(*[F.col(f"`{c}`") for c in keep],
                        *[F.col("_comps")[j].alias(f"{prefix}{j + 1}") for j in range(self.k)])


def _covariance(df: DataFrame, arr_col: str, origin: np.ndarray) -> np.ndarray:
    """Covariance matrix of the array column in one pass. Each task sums around
    the mean of its own rows, so nearly constant features keep their digits;
    ``origin``, a row, makes constant ones exactly zero."""
    d = origin.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(d), np.zeros((d, d))
        for batch in batches:
            size = batch.num_rows
            values = batch.column(0).flatten()
            if batch.column(0).null_count or values.null_count or len(values) != size * d:
                raise ValueError("each row needs all features")
            if size:
                x = values.to_numpy(zero_copy_only=False).reshape(size, d) - origin
                own = x.mean(axis=0)
                x -= own
                products += x.T @ x + np.outer(own - mean, own - mean) * (n * size / (n + size))
                mean += (own - mean) * (size / (n + size))
                n += size
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(n)]), pa.array([mean], pa.list_(pa.float64())),
                 pa.array([products.ravel()], pa.list_(pa.float64()))], ["n", "mean", "products"])

    # a row a task: first the mean of all, then the tasks' sums around it
    tasks = (df.select(F.col(arr_col).cast("array<double>").alias("x"))
             .mapInArrow(run, "n double, mean array<double>, products array<double>").persist())
    try:
        mean, n = tasks.agg(Summarizer.mean(array_to_vector("mean"), F.col("n")), F.sum("n")).head()
        between = F.flatten(F.transform(
            F.zip_with("mean", F.lit(mean.toArray().tolist()), lambda a, b: a - b),
            lambda a: F.transform(F.zip_with("mean", F.lit(mean.toArray().tolist()), lambda x, y: x - y),
                                  lambda b: a * b * F.col("n"))))
        sums = F.zip_with("products", between, lambda a, b: a + b)
        total = tasks.agg(Summarizer.sum(array_to_vector(sums))).head()[0].toArray().reshape(d, d)
    finally:
        tasks.unpersist()
    return total / (n - 1.0) if n > 1 else np.zeros((d, d))


def fit_components(df: DataFrame, arr_col: str, names: Sequence[str] | None = None,
                   k: int | None = 9, confidence: float = 0.999,
                   override_components: bool = True,
                   max_dim: int | None = None) -> Components:
    """M1: principal components of the correlation matrix of ``arr_col``
    (already normalised rows), i.e. Spark's PCA on the rows scaled to unit
    standard deviation without centring. ``k`` components are kept; when
    fewer than needed for ``confidence`` are asked for, a warning is given
    and, with ``override_components``, k is raised to that count (O3).

    The d x d covariance and its eigenvectors are on the driver; ``max_dim``
    refuses wider inputs where the caller wants a bound.

    Pass a persisted ``df``: with more than ``FEW_FEATURES`` the fit reads it for
    the scaler and for the covariance; only d-sized and d x d results reach the driver."""
    if not 0.0 <= confidence <= 1.0:
        raise ValueError("confidence must be within [0, 1]")
    vec = df.select(to_vector(F.col(arr_col)).alias("_x"))
    first = vec.head()
    if first is None:
        raise ValueError("no rows to fit components on (did the filters remove every row?)")
    few = 0 < first[0].size <= FEW_FEATURES
    if few:
        covariance = _covariance(df, arr_col, first[0].toArray())
        std = np.sqrt(np.diag(covariance))
    else:
        scaler = StandardScaler(inputCol="_x", outputCol="_xs", withMean=False,
                                withStd=True).fit(vec)
        std = np.asarray(scaler.std.toArray(), dtype=float)
    d = std.size
    if d == 0:
        raise ValueError("no features")
    if max_dim is not None and d > max_dim:
        raise ValueError(f"{d} features is above the given width {max_dim}")
    names = list(names) if names is not None else [f"f{i}" for i in range(d)]
    if len(names) != d:
        raise ValueError(f"{len(names)} names for {d} features")
    constant = [names[i] for i in range(d) if not std[i] > 0.0]
    if constant:
        warnings.warn(f"constant features left out of the components: {constant}")
    if len(constant) == d:
        raise ValueError("every feature is constant; no components")
    pca = None
    if few:
        scale = np.divide(1.0, std, out=np.zeros(d), where=std != 0.0)
        raw, variance, _ = np.linalg.svd(covariance * np.outer(scale, scale))
        ratios = variance / variance.sum()
    else:
        pca = PCA(k=d, inputCol="_xs", outputCol="_pcs").fit(scaler.transform(vec))
        ratios = np.asarray(pca.explainedVariance.toArray(), dtype=float)
        raw = np.asarray(pca.pc.toArray(), dtype=float)
    signs = sign_rule(raw)
    vectors = raw * signs
    # the trace of a correlation matrix is its count of non-constant features
    eigenvalues = ratios * float(d - len(constant))
    k_conf = components_for_confidence(ratios, confidence)
    if k is None:
        k = k_conf
    if k > d:
        warnings.warn(f"asked for {k} components of {d} features; using {d}")
        k = d
    if k < k_conf:
        warnings.warn(f"{k} components explain less than {confidence:.4%} of the variance; "
                      f"{k_conf} are needed")
        if override_components:
            k = k_conf
    return Components(names, eigenvalues, vectors, int(k), int(k_conf), float(confidence),
                      constant, pca, signs)
