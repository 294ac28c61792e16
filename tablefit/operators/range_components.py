"""Leading components of wide rows by a randomised range finder (A1, M1, O1, O2).

The components are those of the correlation matrix, as in ``components.py``,
but that d x d matrix is never built. A random d x l matrix, l a little above
the k components asked for, is multiplied by it a few times: a pass over the
matrix blocks sums ``X'(X W)`` of the centred rows, the driver scales the d x l
result and makes its columns orthonormal again. The eigenvectors of the small
matrix that remains give the components. The driver and the tasks hold d x l
numbers, so tens of thousands of features are no matter.

Directions of near-equal eigenvalues are as arbitrary as ever; those apart
from the rest converge by the ratio of the eigenvalues with every iteration.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.operators.blocks import Block, Blocks, to_blocks
from tablefit.operators.components import fix_signs
from tablefit.functions.vectors import to_vector

OVERSAMPLE = 8
ITERATIONS = 6


@dataclass
class RangeComponents:
    names: list[str]
    eigenvalues: np.ndarray          # of the k components, descending
    vectors: np.ndarray              # d x k, sign-fixed
    constant: list[str] = field(default_factory=list)

    @property
    def ratios(self) -> np.ndarray:
        """Explained shares: the trace of a correlation matrix is its count of features that vary."""
        return self.eigenvalues / (len(self.names) - len(self.constant))

    def project(self, df: DataFrame, arr_col: str, keep: Sequence[str] = (), prefix: str = "Comp") -> DataFrame:
        """Rows -> ``keep..., Comp1..Compk``, of the rows as they are (neither centred nor scaled)."""
        vectors, n_keep = self.vectors, len(keep)
        names = [f"{prefix}{j + 1}" for j in range(vectors.shape[1])]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column(n_keep).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                out = x.reshape(batch.num_rows, -1) @ vectors if batch.num_rows else np.empty((0, vectors.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(n_keep)] + [pa.array(out[:, j]) for j in range(out.shape[1])],
                    [*keep, *names])

        rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(arr_col).cast("array<double>").alias("_x"))
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]] + [f"`{c}` double" for c in names])
        return rows.mapInArrow(run, schema)


def _summed(blocks: Blocks, of: callable, shape: tuple[int, ...]) -> np.ndarray:
    def per_task(parts: Iterable[Block]) -> dict[int, np.ndarray]:
        total = None
        for x, _, _ in parts:
            part = of(x)
            total = part if total is None else total + part
        return {} if total is None else {0: total}
    got = blocks.summed(per_task).get(0)
    if got is None:
        raise ValueError("no rows to fit components on (did the filters remove every row?)")
    return got.reshape(shape)


def fit_range_components(df: DataFrame, arr_col: str, names: Sequence[str], k: int, oversample: int = OVERSAMPLE,
                         iterations: int = ITERATIONS, seed: int = 0) -> RangeComponents:
    """The first ``k`` components of the correlation matrix of ``arr_col``."""
    d = len(names)
    if not 1 <= k <= d:
        raise ValueError(f"{k} components of {d} features")
    blocks = to_blocks(df.select(to_vector(F.col(arr_col)).alias("x")), "x", {})
    try:
        sums = _summed(blocks, lambda x: np.concatenate(([len(x)], x.sum(axis=0))), (-1,))
        n, mean = sums[0], sums[1:] / sums[0]
        if len(mean) != d:
            raise ValueError(f"{d} names for {len(mean)} features")
        spread = np.sqrt(_summed(blocks, lambda x: ((x - mean) ** 2).sum(axis=0), (d,)) / n)
        varies = spread > 1e-12 * np.maximum(np.abs(mean), 1e-300)
        if not varies.any():
            raise ValueError("every feature is constant; no components")
        scale = np.where(varies, 1.0 / np.where(varies, spread, 1.0), 0.0)
        width = int(min(varies.sum(), k + oversample))

        def times(q: np.ndarray) -> np.ndarray:
            """The correlation matrix times ``q``."""
            w = scale[:, None] * q

            def of(x: np.ndarray) -> np.ndarray:
                centred = x - mean
                return centred.T @ (centred @ w)
            return scale[:, None] * _summed(blocks, of, q.shape) / n

        q = np.linalg.qr(np.where(varies[:, None], np.random.default_rng(seed).normal(size=(d, width)), 0.0))[0]
        for _ in range(iterations):
            q = np.linalg.qr(times(q))[0]
        small = q.T @ times(q)
    finally:
        blocks.unpersist()
    values, inner = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(values))[:k]
    vectors = q @ inner[:, order]
    return RangeComponents(list(names), values[order], fix_signs(vectors), [c for c, v in zip(names, varies) if not v])
