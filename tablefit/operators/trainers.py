"""Trainers (M3-M12, M17) as ``pyspark.ml`` pipelines.

Parameters are given in the reference run's own names (``iterations``,
``regParam``, ``intercept``, ``lambda_`` ...) and mapped onto the ML
estimators. Label handling (Q7): logistic regression and SVM learn a
two-class label ``label > 0``; the multinomial logistic regression and
naive Bayes learn indexed label values and their predictions are decoded
back to label values. Every step is a pipeline stage, so fitting and
scoring are distributed Spark jobs; only coefficients reach the driver.
"""

from __future__ import annotations

import copy
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer
from pyspark.ml.regression import IsotonicRegression, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tablefit.functions.fixed import TRAINER_DEFAULTS
from tablefit.operators.blocks import to_blocks
from tablefit.operators.newton import MAX_WEIGHTS, LogisticFitted, fits_newton, newton_weights

BINARY = {"logistic", "svm"}
MULTICLASS = {"multinomial", "naive_bayes"}
REGRESSION = {"linear", "ridge", "lasso", "isotonic"}
TRAINERS = sorted(BINARY | MULTICLASS | REGRESSION)

_LABEL01 = "_label01"
_LABEL_IDX = "_label_idx"
_PRED_RAW = "_prediction_raw"


def trainer_params(name: str, override: Mapping | None = None) -> dict:
    """A fresh copy of the defaults with ``override`` applied (each
    override starts again from the defaults)."""
    if name not in TRAINER_DEFAULTS:
        raise ValueError(f"unknown trainer {name!r}; known: {sorted(TRAINER_DEFAULTS)}")
    params = copy.deepcopy(TRAINER_DEFAULTS[name])
    params.update(dict(override or {}))
    return params


def _elastic_net(params: Mapping) -> float:
    reg_type = params.get("regType", "l2")
    return 1.0 if reg_type == "l1" else 0.0


def build_estimator(name: str, params: Mapping, features_col: str, label_col: str,
                    label_std: float | None = None, feature_index: int = 0):
    """The ML estimator for one trainer (without label encoding)."""
    tol = float(params.get("convergenceTol", params.get("tolerance", 1e-6)))
    it = int(params.get("iterations", 100))
    reg = float(params.get("regParam", 0.0) or 0.0)
    intercept = bool(params.get("intercept", False))
    common = dict(featuresCol=features_col, labelCol=label_col, predictionCol="prediction")
    if name == "logistic":
        return LogisticRegression(maxIter=it, regParam=reg, elasticNetParam=_elastic_net(params),
                                  fitIntercept=intercept, standardization=False, tol=tol,
                                  family="binomial", **common)
    if name == "multinomial":
        return LogisticRegression(maxIter=it, regParam=reg, elasticNetParam=_elastic_net(params),
                                  fitIntercept=intercept, standardization=False, tol=tol,
                                  family="multinomial", **common)
    if name == "svm":
        return LinearSVC(maxIter=it, regParam=reg, fitIntercept=intercept,
                         standardization=False, tol=tol, **common)
    if name == "naive_bayes":
        return NaiveBayes(smoothing=float(params.get("lambda_", 1.0)), modelType="multinomial",
                          **common)
    if name == "linear":
        return LinearRegression(maxIter=it, regParam=0.0, elasticNetParam=0.0,
                                fitIntercept=intercept, standardization=False, tol=tol,
                                solver="normal", **common)
    if name == "ridge":
        # Spark divides the L2 term by the label's standard deviation; pass
        # regParam * sigma_y so the fitted objective is the plain ridge one.
        sigma = 1.0 if label_std is None else float(label_std)
        return LinearRegression(maxIter=it, regParam=reg * sigma, elasticNetParam=0.0,
                                fitIntercept=intercept, standardization=False, tol=tol,
                                solver="normal", **common)
    if name == "lasso":
        return LinearRegression(maxIter=it, regParam=reg, elasticNetParam=1.0,
                                fitIntercept=intercept, standardization=False,
                                tol=tol, solver="l-bfgs", **common)
    if name == "isotonic":
        return IsotonicRegression(isotonic=bool(params.get("isotonic", True)),
                                  featureIndex=feature_index, **common)
    raise ValueError(f"unknown trainer {name!r}; known: {TRAINERS}")


@dataclass
class Fitted:
    name: str
    params: dict
    model: PipelineModel
    scored_label: str            # column compared with ``prediction``
    labels: list[float] | None = None   # class values by index (multiclass)

    @property
    def estimator_model(self):
        return self.model.stages[1] if self.name in BINARY | MULTICLASS else self.model.stages[0]

    def add_prediction(self, df: DataFrame, out_col: str, features_col: str = "features") -> DataFrame:
        """Adds only ``out_col`` (prediction in label units for multiclass
        trainers, 0/1 for two-class ones); many fitted models can be chained
        over one scan of ``df``."""
        m = self.estimator_model.copy()
        m.setFeaturesCol(features_col).setPredictionCol(out_col)
        for setter in ("setRawPredictionCol", "setProbabilityCol"):
            if hasattr(m, setter):
                getattr(m, setter)("")
        out = m.transform(df)
        if self.name in MULTICLASS and self.labels is not None:
            values = F.array(*[F.lit(float(v)) for v in self.labels])
            out = out.withColumn(out_col, F.try_element_at(values, F.col(out_col).cast("int") + 1))
        return out

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` (in label units for multiclass trainers) and
        keeps ``scored_label``."""
        if self.name in MULTICLASS:
            # the label indexer is for fitting only: rows to score may have
            # other labels, or none
            out = PipelineModel(self.model.stages[1:]).transform(df)
            out = out.drop("prediction").withColumnRenamed(_PRED_RAW, "prediction")
            return out.withColumn("prediction", F.col("prediction").cast("double"))
        return self.model.transform(df)

    def coefficients(self) -> list[float]:
        est = self.model.stages[-1] if self.name not in MULTICLASS else self.model.stages[-2]
        if hasattr(est, "coefficients"):
            return [float(x) for x in est.coefficients.toArray()]
        return []


def label_std(df: DataFrame, label_col: str) -> float:
    """Population standard deviation of the label (one aggregate)."""
    v = df.agg(F.stddev_pop(F.col(label_col)).alias("s")).head()["s"]
    return float(v or 0.0) or 1.0


def build_pipeline(name: str, params: Mapping, features_col: str = "features",
                   label_col: str = "label", score_against: str = "encoded",
                   label_sd: float | None = None, feature_index: int = 0) -> tuple[Pipeline, str]:
    """Pipeline with label encoding + estimator; returns it with the name of
    the label column the predictions should be scored against."""
    if name in BINARY:
        enc = SQLTransformer(statement=(
            f"SELECT *, CASE WHEN `{label_col}` > 0 THEN 1.0 ELSE 0.0 END AS {_LABEL01} "
            f"FROM __THIS__"))
        est = build_estimator(name, params, features_col, _LABEL01)
        scored = _LABEL01 if score_against == "encoded" else label_col
        return Pipeline(stages=[enc, est]), scored
    if name in MULTICLASS:
        idx = StringIndexer(inputCol=label_col, outputCol=_LABEL_IDX,
                            stringOrderType="alphabetAsc", handleInvalid="error")
        est = build_estimator(name, params, features_col, _LABEL_IDX)
        # decoded after fit (labels known only then): see fit()
        return Pipeline(stages=[idx, est]), label_col
    est = build_estimator(name, params, features_col, label_col, label_std=label_sd,
                          feature_index=feature_index)
    return Pipeline(stages=[est]), label_col


def fit(name: str, train: DataFrame, features_col: str = "features", label_col: str = "label",
        override: Mapping | None = None, score_against: str = "encoded",
        feature_index: int = 0, label_sd: float | None = None,
        optimizer: str = "ml") -> Fitted | LogisticFitted:
    """Fit one trainer on ``train`` and return the model (M12 through
    :meth:`Fitted.predict`). With ``optimizer="newton"`` the logistic trainers
    with an L2 penalty, no intercept and at most ``MAX_WEIGHTS`` weights reach
    the minimum of their objective in a few passes over matrix blocks."""
    if optimizer not in ("ml", "newton"):
        raise ValueError(f"unknown optimizer {optimizer!r}")
    params = trainer_params(name, override)
    if name == "ridge" and label_sd is None:
        label_sd = label_std(train, label_col)
    pipe, scored = build_pipeline(name, params, features_col, label_col, score_against,
                                  label_sd, feature_index)
    if name in MULTICLASS:
        # + 0.0: a negative zero is the class of zero
        train = train.where(F.col(label_col).isNotNull()).withColumn(
            label_col, F.col(label_col).cast("double") + F.lit(0.0))
        indexer = pipe.getStages()[0].fit(train)
        classes = len(indexer.labelsArray[0])
        pipe = Pipeline(stages=[indexer, pipe.getStages()[1]])
    if optimizer == "newton" and name in ("logistic", "multinomial") and fits_newton(params):
        first = train.select(features_col).head()
        rows = classes if name == "multinomial" else 1
        if first is not None and rows * first[0].size <= MAX_WEIGHTS:
            encoded = pipe.getStages()[0].transform(train) if name == "logistic" else indexer.transform(train)
            target = F.col(_LABEL01 if name == "logistic" else _LABEL_IDX)
            blocks = to_blocks(encoded, features_col, {label_col: target})
            try:
                weights = newton_weights(blocks, rows, float(params["regParam"]), first[0].size)
            finally:
                blocks.unpersist()
            values = [float(x) for x in indexer.labelsArray[0]] if name == "multinomial" else None
            return LogisticFitted(name, params, weights, values, scored)
    if name == "isotonic":
        # one row per feature value, weighted by its rows: the same solution,
        # and no value however frequent meets in one task
        value = vector_to_array(F.col(features_col))[feature_index]
        points = (train.where(F.col(label_col).isNotNull())
                  .groupBy(value.alias("_x"))
                  .agg(F.avg(label_col).alias(label_col),
                       F.count(F.lit(1)).cast("double").alias("_weight"))
                  .select(array_to_vector(F.array("_x")).alias(features_col), label_col, "_weight"))
        est = pipe.getStages()[0].copy().setFeatureIndex(0).setWeightCol("_weight")
        model = PipelineModel([est.fit(points).setFeatureIndex(feature_index)])
        return Fitted(name, params, model, scored)
    model = pipe.fit(train)
    labels = None
    if name in MULTICLASS:
        labels = list(model.stages[0].labelsArray[0])
        decode = IndexToString(inputCol="prediction", outputCol=_PRED_RAW, labels=labels)
        model = PipelineModel(stages=list(model.stages) + [decode])
        labels = [float(x) for x in labels]
    return Fitted(name, params, model, scored, labels)


def effective_key(name: str, params: Mapping) -> tuple:
    """What the fitted ML model depends on: settings without an ML
    counterpart (``step``, ``miniBatchFraction``) do not make a new fit."""
    est = build_estimator(name, params, "features", "label")
    return tuple(sorted((p.name, repr(v)) for p, v in est.extractParamMap().items()))


# ---------------------------------------------------------------------------
# Naive Bayes from sufficient statistics: a smoothing sweep needs one
# aggregation per label, not one pass per smoothing value.
# ---------------------------------------------------------------------------
@dataclass
class BayesStatistics:
    labels: list[float]          # class values, in the indexer's order
    counts: np.ndarray           # rows per class
    sums: np.ndarray             # C x d feature sums per class


def bayes_statistics(train: DataFrame, features_col: str, label_col: str) -> BayesStatistics:
    """One grouped aggregate (pre-aggregated map-side, one row per class and
    task shuffled): class counts and feature sums. Classes are ordered like
    ``StringIndexer(stringOrderType="alphabetAsc")``."""
    rows = (train.where(F.col(label_col).isNotNull())
            .groupBy((F.col(label_col).cast("double") + F.lit(0.0)).alias("_v"))
            .agg(F.count(F.lit(1)).alias("_n"),
                 Summarizer.sum(F.col(features_col)).alias("_s"),
                 Summarizer.min(F.col(features_col)).alias("_m"))
            .collect())  # a row per class
    if not rows:
        raise ValueError("no labelled rows")
    rows.sort(key=lambda r: str(r["_v"]))
    if min(float(r["_m"].toArray().min()) for r in rows) < 0:
        raise ValueError("naive Bayes (multinomial) needs non-negative features")
    return BayesStatistics([float(r["_v"]) for r in rows],
                           np.array([float(r["_n"]) for r in rows]),
                           np.vstack([r["_s"].toArray() for r in rows]))


def bayes_statistics_many(train: DataFrame, features_col: str,
                          label_cols: Mapping[str, str]) -> dict[str, BayesStatistics]:
    """:func:`bayes_statistics` for several labels in ONE pass: each row is
    exploded into one (label name, label value) pair per label and a single
    grouped aggregate (partial per task) sums features per pair."""
    names = list(label_cols)
    if not names:
        return {}
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("_e"), F.col(label_cols[n]).alias("_v"))
        for i, n in enumerate(names)])).alias("_p")
    rows = (train.select(F.col(features_col).alias("_f"), pairs)
            .where(F.col("_p._v").isNotNull())
            .groupBy(F.col("_p._e").alias("_e"),
                     (F.col("_p._v").cast("double") + F.lit(0.0)).alias("_v"))
            .agg(F.count(F.lit(1)).alias("_n"),
                 Summarizer.sum(F.col("_f")).alias("_s"),
                 Summarizer.min(F.col("_f")).alias("_m"))
            .collect())  # a row per label expression and class
    out: dict[str, BayesStatistics] = {}
    for i, name in enumerate(names):
        mine = sorted((r for r in rows if r["_e"] == i), key=lambda r: str(r["_v"]))
        if not mine:
            raise ValueError(f"no labelled rows for {name!r}")
        if min(float(r["_m"].toArray().min()) for r in mine) < 0:
            raise ValueError("naive Bayes (multinomial) needs non-negative features")
        out[name] = BayesStatistics([float(r["_v"]) for r in mine],
                                    np.array([float(r["_n"]) for r in mine]),
                                    np.vstack([r["_s"].toArray() for r in mine]))
    return out


@dataclass
class BayesFromStatistics:
    """Multinomial naive Bayes with smoothing ``lambda_`` (same estimates as
    ``pyspark.ml.classification.NaiveBayes``):
    pi_c = ln(n_c + l) - ln(n + C l), theta_cj = ln(s_cj + l) - ln(sum_j s_cj + d l)."""
    name: str
    params: dict
    stats: BayesStatistics
    scored_label: str = "label"

    @property
    def pi(self) -> np.ndarray:
        lam = float(self.params.get("lambda_", 1.0))
        c = len(self.stats.labels)
        return np.log(self.stats.counts + lam) - np.log(self.stats.counts.sum() + c * lam)

    @property
    def theta(self) -> np.ndarray:
        lam = float(self.params.get("lambda_", 1.0))
        d = self.stats.sums.shape[1]
        return (np.log(self.stats.sums + lam)
                - np.log(self.stats.sums.sum(axis=1, keepdims=True) + d * lam))

    def prediction_column(self, x: Column) -> Column:
        """The predicted class value from ``x`` (the features as an array):
        argmax_c pi_c + sum_j theta_cj x_j, the first class winning a tie.
        Scores are compact higher-order functions, so many models fit in
        one projection."""
        pi, theta = self.pi, self.theta
        # theta . x first, then pi (Spark's order; exact ties at rounding
        # level can still fall either way)
        scores = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in theta[c]]),
                                         lambda a, b: a * b),
                              F.lit(0.0), lambda acc, v: acc + v) + F.lit(float(pi[c]))
                  for c in range(len(self.stats.labels))]
        if len(scores) == 1:
            return F.lit(self.stats.labels[0])
        best = F.greatest(*scores)
        pred = None
        for c, value in enumerate(self.stats.labels):
            cond = scores[c] == best
            pred = F.when(cond, F.lit(value)) if pred is None else pred.when(cond, F.lit(value))
        return pred

    def add_prediction(self, df: DataFrame, out_col: str, features_col: str = "features") -> DataFrame:
        return df.withColumn(out_col, self.prediction_column(
            vector_to_array(F.col(features_col), "float64")))


def bayes_batch_predictions(models: Sequence[BayesFromStatistics], x: Column) -> Column:
    """Predictions of many naive Bayes models that share one label (the
    same class list), as ``array<double>`` with one entry per model.

    Scoring is a matrix product, argmax_c (pi_mc + theta_mc . x), so it runs
    as an Arrow-batched pandas UDF: one ``numpy.einsum`` per batch for all
    models and classes, instead of models x classes interpreted
    higher-order functions per row (the first class wins a tie, as in
    Spark)."""
    if not models:
        raise ValueError("no models")
    labels = np.asarray(models[0].stats.labels, dtype=float)
    for m in models[1:]:
        if list(m.stats.labels) != list(labels):
            raise ValueError("models must share their classes")
    theta = np.stack([m.theta for m in models])          # (models, classes, d)
    pi = np.stack([m.pi for m in models])                # (models, classes)

    @pandas_udf(T.ArrayType(T.DoubleType()))
    def _predict(xs: pd.Series) -> pd.Series:
        if len(xs) == 0:
            return pd.Series([], dtype=object)
        mat = np.vstack(xs.to_numpy()).astype(float)                       # (rows, d)
        scores = np.einsum("nd,mcd->nmc", mat, theta) + pi[None, :, :]
        return pd.Series(list(labels[scores.argmax(axis=2)]))

    return _predict(x)
