"""The full run (section 3.1): season CSV files -> collated table ->
label-prefix check -> filters -> components -> sweep -> metric report.

Defaults reproduce the original run's settings: seasons 2000-2014,
all exclusion families, labels FTHG..HTR, four label expressions, k = 9
components at confidence 0.999, logistic regression / naive Bayes / SVM
over their override lists (92 fits).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablefit.functions.fixed import (CATALOGUE, LABEL_EXPRESSIONS, LABELS, MAIN_RUN_END_YEAR,
                                      MAIN_RUN_START_YEAR, MAIN_RUN_TRAINERS, PCA_COMPONENTS,
                                      PCA_CONFIDENCE, RESULT_CATEGORIES)
from tablefit.operators.checks import assert_label_prefix
from tablefit.operators.exclude import exclusion_list
from tablefit.plans.model_run import run_sweep
from tablefit.sources.csv_tables import Collated, collate
from tablefit.sources.seasons import DEFAULT_TEMPLATE
from tablefit.sources.tables import write_table


@dataclass
class RunResult:
    report: DataFrame
    collated: Collated
    table_path: str | None


def collate_seasons(spark: SparkSession, root: str, start_year: int = MAIN_RUN_START_YEAR,
                    end_year: int = MAIN_RUN_END_YEAR, exc_handicap: bool = True,
                    exc_averages: bool = True, exc_2_5_goals: bool = True,
                    categories: Mapping[str, float] = RESULT_CATEGORIES,
                    template: str = DEFAULT_TEMPLATE, extra_excludes: Sequence[str] = (),
                    catalogue: Sequence[str] = CATALOGUE, min_year: int | None = None,
                    max_year: int | None = None) -> Collated:
    """Section 3.2: the parser alone."""
    excludes = exclusion_list(exc_handicap, exc_averages, exc_2_5_goals, extra=extra_excludes)
    return collate(spark, root, start_year, end_year, excludes, categories, template,
                   key_col="match_key", catalogue=catalogue, min_year=min_year,
                   max_year=max_year)


def main_run(spark: SparkSession, root: str, start_year: int = MAIN_RUN_START_YEAR,
             end_year: int = MAIN_RUN_END_YEAR, labels: Sequence[str] = LABELS,
             expressions: Sequence[str] = LABEL_EXPRESSIONS,
             trainers: Sequence[str] = MAIN_RUN_TRAINERS, k: int | None = PCA_COMPONENTS,
             confidence: float = PCA_CONFIDENCE, override_components: bool = True,
             drop_zero: bool = True, table_path: str | None = None, parallelism: int = 8,
             score_against: str = "encoded", checkpoint: bool = True,
             optimizer: str = "shared", partitions: int | None = None, **collate_args) -> RunResult:
    """Collate, check, (optionally store as Parquet by start_year), then run
    the sweep. Returns the report (one row per fit)."""
    col = collate_seasons(spark, root, start_year, end_year, **collate_args)
    assert_label_prefix(col.inventory, list(labels))
    table = col.table
    if table_path is not None:
        write_table(table, table_path)
        table = spark.read.parquet(table_path)
    features = [t for t in col.titles if t not in set(labels)]
    report = run_sweep(table, labels, features, ["match_key"], trainers, expressions, k,
                       confidence, parallelism, score_against, optimizer=optimizer,
                       override_components=override_components, drop_zero=drop_zero,
                       checkpoint=checkpoint, partitions=partitions, computed=table_path is None)
    return RunResult(report, col, table_path)
