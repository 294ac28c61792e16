"""The model run: filters -> normalised features -> components -> labelled
rows -> hold-out split -> fits -> metric report (sections 3.1, 3.3).

All steps are lazy DataFrame transformations except three small driver
results: the d x d correlation matrix (components), fitted coefficients,
and the metric rows. The prepared rows are persisted once and shared by
every fit of a sweep; of typed cells, which cost most to compute, a table in
the scratch folder is kept instead, and what follows from it is computed again.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.functions.fixed import (LABEL_EXPRESSIONS, LABELS, MAIN_RUN_TRAINERS,
                                      PCA_COMPONENTS, PCA_CONFIDENCE, PCA_NORM_P,
                                      TRAIN_SHARE, TRAINER_OVERRIDES)
from tablefit.functions.labels import check_label_expression, label_column
from tablefit.functions.vectors import feature_array, l1_abs_normalize, lp_normalize, to_vector
from tablefit.operators.checks import drop_empty_features, drop_unusable_labels
from tablefit.operators.components import Components, fit_components
from tablefit.operators.blocks import counts, label_sets, to_blocks
from tablefit.operators.gradient import LOSSES, Spec, fit_descent, fit_optimal
from tablefit.operators.isotonic import fit_isotonic
from tablefit.operators.least_squares import LEAST_SQUARES, fit_least_squares, moments
from tablefit.operators.metrics import regression_metrics
from tablefit.operators.scoring import predictor_of, score_models
from tablefit.operators.split import key_split
from tablefit.operators import trainers as tr
from tablefit.operators.sgd import fitted_of
from tablefit.session import checkpoint_root, delete_path, scratch_dir


@dataclass
class Prepared:
    rows: DataFrame              # keys..., labels..., is_test, features (vector)
    components: Components | None
    labels: list[str]
    keys: list[str]
    base: DataFrame | None = None  # persisted normalised rows that ``rows`` is read from
    cells: str | None = None       # folder of the stored cells that ``rows`` is read from

    def unpersist(self) -> None:
        self.rows.unpersist()
        if self.base is not None:
            self.base.unpersist()
        if self.cells is not None:
            delete_path(self.rows.sparkSession, self.cells)


def _usable(df: DataFrame, labels: Sequence[str], features: Sequence[str], drop_zero: bool) -> DataFrame:
    """F1 + F2."""
    return drop_empty_features(drop_unusable_labels(df, labels, drop_zero), features)


def _counted(df: DataFrame) -> DataFrame:
    """``df`` below a count, through which no filter goes down."""
    return df.observe(Observation(), F.count(F.lit(1)).alias("n_rows"))


def store_cells(df: DataFrame, labels: Sequence[str], features: Sequence[str],
                keys: Sequence[str] = (), drop_zero: bool = True) -> tuple[DataFrame, str]:
    """The rows that pass F1 + F2, their computed columns (typed cells) written once
    to a table in the scratch folder: ``keys..., labels..., features...`` and the
    folder. Cells are a fraction of the normalised rows, which no two rows share a
    value of, and a reader streams them, so neither memory nor caches grow with
    them. Columns are stored by position: titles may hold any character."""
    names = list(dict.fromkeys([*keys, *labels, *features]))
    used = _usable(_counted(df), labels, features, drop_zero).select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    path = scratch_dir(df.sparkSession, "cells")
    used.write.parquet(path)
    stored = df.sparkSession.read.schema(used.schema).parquet(path)
    return stored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]), path


def normalised_rows(df: DataFrame, labels: Sequence[str], features: Sequence[str],
                    keys: Sequence[str] = (), drop_zero: bool = True, p: float = PCA_NORM_P,
                    filter_rows: bool = True, computed: bool = False,
                    partitions: int | None = None) -> DataFrame:
    """F1 + F2, then features as one array (nulls as 0) normalised by the
    row Lp norm (V1): ``keys..., labels..., x``. Filters on columns that a file
    holds go down to the scan; ``computed`` ones (typed cells) are computed once
    a row instead, below a count that keeps filters and norm from computing
    them again. ``partitions`` deals the rows that pass out by their keys, as
    the input has them: these are smaller than normalised ones, which no two
    rows share a value of."""
    if computed:
        df = _counted(df)
    if filter_rows:
        df = _usable(df, labels, features, drop_zero)
    if partitions:
        used = [F.col(f"`{c}`") for c in dict.fromkeys([*keys, *labels, *features])]
        df = df.select(*used).repartition(partitions, *[F.col(f"`{k}`") for k in keys])
    return df.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{l}`") for l in labels],
                     lp_normalize(feature_array(features), p, len(features)).alias("x"))


def prepare(df: DataFrame, labels: Sequence[str], features: Sequence[str],
            keys: Sequence[str], k: int | None = PCA_COMPONENTS,
            confidence: float = PCA_CONFIDENCE, override_components: bool = True,
            drop_zero: bool = True, p: float = PCA_NORM_P, use_components: bool = True,
            test_fraction: float = 1.0 - TRAIN_SHARE, seed: int = 0,
            persist: bool = True, checkpoint: bool = False,
            partitions: int | None = None, computed: bool = False) -> Prepared:
    """Everything up to the labelled rows, shared by all label expressions
    and trainers: components are fitted once (not before every fit).

    With ``checkpoint`` the prepared rows are also written to the session's
    checkpoint folder (shared storage on a cluster) and their lineage is
    cut, so a long sweep that loses executors reloads them instead of
    re-reading and re-shuffling the input. Without ``persist`` the normalised
    rows stay persisted instead, until ``unpersist``: fits read these, and what
    is computed from the rows later reads the input. ``partitions`` deals the rows out by
    their keys before anything is fitted; by default they stay in the
    partitions of the scan, which may be few for a file of few row groups.
    ``computed`` columns go to a stored table (:func:`store_cells`) until
    ``unpersist``, from which the rows are computed wherever they are read; nothing
    else is persisted or checkpointed then, since their lineage ends in that table."""
    cells = None
    if computed:
        df, cells = store_cells(df, labels, features, keys, drop_zero)
        persist = checkpoint = False
    base = normalised_rows(df, labels, features, keys, drop_zero, p, filter_rows=cells is None,
                           partitions=partitions)
    comps, width = None, len(features)
    if use_components:
        if cells is None:
            base = base.persist(StorageLevel.MEMORY_AND_DISK)
        comps = fit_components(base, "x", list(features), k, confidence, override_components)
        width = comps.k
        projected = comps.transform(base, "x", "_comps").select(
            *[F.col(f"`{c}`") for c in list(keys) + list(labels)], F.col("_comps").alias("x"))
    else:
        projected = base
    # V3: absolute values, L1-normalised (the labelled-point features)
    rows = projected.select(*[F.col(f"`{c}`") for c in list(keys) + list(labels)],
                            to_vector(l1_abs_normalize(F.col("x"), width)).alias("features"))
    rows = key_split(rows, list(keys), test_fraction, seed)
    if persist or checkpoint:
        # materialise the prepared rows, then release the normalised ones
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        if checkpoint:
            checkpoint_root(rows.sparkSession)
            rows = rows.checkpoint(eager=True).persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()
        if use_components:
            base.unpersist()
    held = base if use_components and cells is None and not (persist or checkpoint) else None
    return Prepared(rows, comps, list(labels), list(keys), held, cells)


def labelled(prep: Prepared, expression: str) -> DataFrame:
    """``label, features, is_test`` for one label expression."""
    check_label_expression(expression, prep.rows.columns)
    return prep.rows.select(label_column(expression, prep.rows.columns).alias("label"),
                            "features", "is_test")


def _params_text(params: Mapping) -> dict[str, str]:
    return {k: json.dumps(v) for k, v in sorted(params.items())}


REPORT_SCHEMA = T.StructType([
    T.StructField("trainer", T.StringType(), False),
    T.StructField("label_expr", T.StringType(), False),
    T.StructField("param_set", T.IntegerType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), False),
])


def evaluate(prep: Prepared, plan: Sequence[tuple[str, str, int, Mapping]],
             score_against: str = "encoded", parallelism: int = 4,
             digits: int | None = None, optimizer: str = "shared") -> DataFrame:
    """Fit every (trainer, label expression, override) of ``plan`` on the
    train rows and score it on the test rows (M11, M12, M15).

    The rows become matrix blocks once. From these,

    - logistic and SVM fits with an L2 penalty share one pass a step, all
      labels and settings together (``optimizer="ml"`` fits each with
      ``pyspark.ml`` instead, ``"sgd"`` runs the configured gradient descent,
      for the least squares trainers as well);
    - linear, ridge and lasso fits follow from one pass of sums;
    - isotonic fits pool their violators in range partitions, and are scored by
      a distributed interpolation;
    - all other models are scored in one pass by partial sums: a row a model and
      task.

    Naive Bayes fits share one sufficient-statistics aggregation, whatever the
    number of labels and smoothing values; the other trainers run concurrently
    as ``pyspark.ml`` jobs. Plan entries whose effective settings are equal
    share one fit (``step`` and ``miniBatchFraction`` only count for "sgd").
    The report is local: a row a plan entry; nothing stays persisted."""
    if optimizer not in ("shared", "ml", "sgd"):
        raise ValueError(f"unknown optimizer {optimizer!r}")
    spark = prep.rows.sparkSession
    expressions = list(dict.fromkeys(e for _, e, _, _ in plan))
    for e in expressions:
        check_label_expression(e, prep.rows.columns)
    label_of = label_sets(expressions)
    ycol = {e: f"_y{i}" for e, i in label_of.items()}

    fits: dict[tuple, tuple[str, str, dict]] = {}
    fit_of_item = []
    for trainer, e, _, override in plan:
        params = tr.trainer_params(trainer, override)
        if optimizer == "sgd" and trainer in LOSSES:
            key = (trainer, e, "sgd", tuple(sorted((k, repr(v)) for k, v in params.items())))
        else:
            key = (trainer, e, tr.effective_key(trainer, params))
        fits.setdefault(key, (trainer, e, params))
        fit_of_item.append(key)
    keys = list(fits)

    def way(trainer: str, params: Mapping) -> str:
        if trainer == "naive_bayes":
            return "bayes"
        if optimizer == "sgd" and trainer in LOSSES:
            return "descent"
        if trainer in LEAST_SQUARES:
            return "moments"
        if trainer == "isotonic" and optimizer != "ml":
            return "pooled"
        l2 = float(params.get("regParam") or 0.0) > 0 and params.get("regType", "l2") == "l2"
        return "planes" if optimizer == "shared" and trainer in LOSSES and l2 else "ml"

    ways: dict[str, list[tuple]] = {}
    for key in keys:
        trainer, _, params = fits[key]
        ways.setdefault(way(trainer, params), []).append(key)

    label_columns = {e: label_column(e, prep.rows.columns) for e in expressions}
    blocks = to_blocks(prep.rows, "features", label_columns, F.col("is_test"))
    try:
        n, held_out = counts(blocks)
        test_ratio = held_out / n if n else None
        fitted: dict[tuple, object] = {}
        train = prep.rows.where(~F.col("is_test")).select(
            "features", *[label_columns[e].alias(ycol[e]) for e in expressions])

        def pool_and_score(key):
            _, e, params = fits[key]
            first = vector_to_array(F.col("features"))[0].alias("x")
            model = fit_isotonic(train.select(first, F.col(ycol[e]).alias("y")), F.col("x"), F.col("y"),
                                 bool(params.get("isotonic", True)))
            test = prep.rows.where(F.col("is_test")).select(first, label_columns[e].alias("y"))
            return regression_metrics(model.predict(test, F.col("x")), "prediction", "y").head()

        def run(key):
            trainer, e, params = fits[key]
            # left uncached on purpose: the iterative estimators cache their
            # own converted instances, which iterate faster than cached rows
            one = train.select("features", F.col(ycol[e]).alias("label"))
            return tr.fit(trainer, one, "features", "label", params, score_against)

        alone = ways.get("ml", [])
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            running = [pool.submit(run, key) for key in alone]
            pooling = {k: pool.submit(pool_and_score, k) for k in ways.get("pooled", [])}
            bayes = ways.get("bayes", [])
            if bayes:
                stats = tr.bayes_statistics_many(train, "features", {e: ycol[e] for e in sorted({k[1] for k in bayes})})
                fitted.update({k: tr.BayesFromStatistics(k[0], fits[k][2], stats[k[1]]) for k in bayes})
            for name, solve in (("planes", fit_optimal), ("descent", fit_descent)):
                mine = ways.get(name, [])
                if mine:
                    results = solve(blocks, [Spec(fits[k][0], label_of[k[1]], fits[k][2]) for k in mine])
                    fitted.update({k: fitted_of(r) for k, r in zip(mine, results)})
            squares = ways.get("moments", [])
            if squares:
                sums = moments(blocks, sorted({label_of[k[1]] for k in squares}))
                for e in dict.fromkeys(k[1] for k in squares):
                    mine = [k for k in squares if k[1] == e]
                    if label_of[e] not in sums:
                        raise ValueError(f"no rows to fit {e!r}")
                    fitted.update(zip(mine, fit_least_squares(sums[label_of[e]], [(fits[k][0], fits[k][2]) for k in mine])))
            fitted.update({k: f.result() for k, f in zip(alone, running)})

            scores = {k: f.result() for k, f in pooling.items()}

        by_blocks = [k for k in keys if k not in scores]
        encoded = [k[0] in tr.BINARY and score_against == "encoded" for k in by_blocks]
        if by_blocks:
            metrics = score_models(blocks, [predictor_of(fitted[k]) for k in by_blocks], [label_of[k[1]] for k in by_blocks], encoded)
            scores.update({by_blocks[r["fit"]]: r for r in metrics.collect()})  # a row a fit
    finally:
        blocks.unpersist()

    figures = ["var", "mae", "mse", "r2", "rmse"]
    rows = []
    for (t, e, i, o), k in zip(plan, fit_of_item):
        r = scores.get(k)
        rows.append((t, e, i, _params_text(tr.trainer_params(t, o)), test_ratio, r["n"] if r else None,
                     *[r[c] if r else None for c in figures]))
    report = spark.createDataFrame(rows, T.StructType(
        [*REPORT_SCHEMA.fields, T.StructField("test_ratio", T.DoubleType()), T.StructField("n", T.LongType()),
         *[T.StructField(c, T.DoubleType()) for c in figures]]))
    if digits is not None:
        report = report.withColumns({c: F.round(c, digits) for c in figures})
    return report


def sweep_plan(trainers: Sequence[str] = MAIN_RUN_TRAINERS,
               expressions: Sequence[str] = LABEL_EXPRESSIONS,
               overrides: Mapping[str, Sequence[Mapping]] | None = None
               ) -> list[tuple[str, str, int, Mapping]]:
    """Label expression x override list, per trainer (a trainer
    without a list runs its defaults once)."""
    overrides = TRAINER_OVERRIDES if overrides is None else overrides
    plan = []
    for trainer in trainers:
        for expression in expressions:
            for idx, o in enumerate(overrides.get(trainer, [{}])):
                plan.append((trainer, expression, idx, dict(o)))
    return plan


def run_sweep(df: DataFrame, labels: Sequence[str] = LABELS, features: Sequence[str] | None = None,
              keys: Sequence[str] = ("match_key",), trainers: Sequence[str] = MAIN_RUN_TRAINERS,
              expressions: Sequence[str] = LABEL_EXPRESSIONS, k: int | None = PCA_COMPONENTS,
              confidence: float = PCA_CONFIDENCE, parallelism: int = 4,
              score_against: str = "encoded", digits: int | None = None,
              optimizer: str = "shared", overrides: Mapping[str, Sequence[Mapping]] | None = None,
              **prepare_args) -> DataFrame:
    """The main run: prepare once, then every fit of the sweep; returns the
    metric report (one row per fit)."""
    if features is None:
        skip = set(labels) | set(keys) | {"season", "start_year", "_corrupt_record",
                                          "width_repaired"}
        features = [c for c in df.columns if c not in skip]
    prep = prepare(df, labels, features, keys, k, confidence, **prepare_args)
    try:
        return evaluate(prep, sweep_plan(trainers, expressions, overrides), score_against,
                        parallelism, digits, optimizer)
    finally:
        prep.unpersist()
