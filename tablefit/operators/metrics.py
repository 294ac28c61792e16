"""Regression metrics of (prediction, label) pairs (A3), one pass.

    var  = mean((p - mean(y))^2)
    MAE  = mean|p - y|
    MSE  = mean((p - y)^2)
    RMSE = sqrt(MSE)
    R2   = 1 - sum (p - y)^2 / sum (y - mean(y))^2      (null when y is constant)

Everything is a partial aggregate (sums and counts) so a grouped report
pre-aggregates map-side and only one small row per group and task is
shuffled, whatever the group sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label",
                       group_by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    # rows without a prediction or a label take no part in any figure
    both = F.col(prediction).isNotNull() & F.col(label).isNotNull()
    p = F.when(both, F.col(prediction).cast("double"))
    y = F.when(both, F.col(label).cast("double"))
    aggs = [
        F.count(p).alias("_n"),
        F.avg(p).alias("_pbar"),
        F.var_pop(p).alias("_vp"),
        F.avg(y).alias("_ybar"),
        F.var_pop(y).alias("_vy"),
        F.sum(F.abs(p - y)).alias("_sae"),
        F.sum((p - y) * (p - y)).alias("_sse"),
    ]
    g = df.groupBy(*group_by) if group_by else df.groupBy()
    a = g.agg(*aggs)
    n = F.when(F.col("_n") > 0, F.col("_n").cast("double"))
    # mean((p - mean(y))^2) as spread plus shift: no large numbers cancel
    shift = F.col("_pbar") - F.col("_ybar")
    var = F.col("_vp") + shift * shift
    mse = F.col("_sse") / n
    r2 = F.when(F.col("_vy") == 0.0, F.lit(None).cast("double")).otherwise(
        F.lit(1.0) - F.col("_sse") / (F.col("_vy") * n))
    cols = {
        "n": F.col("_n"),
        "var": var,
        "mae": F.col("_sae") / n,
        "mse": mse,
        "r2": r2,
        "rmse": F.sqrt(mse),
    }
    out = []
    for name, c in cols.items():
        if digits is not None and name != "n":
            c = F.round(c, digits)
        out.append(c.alias(name))
    return a.select(*[F.col(g_) for g_ in group_by], *out)
