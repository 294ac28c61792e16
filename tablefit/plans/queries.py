"""Queries over the driver's tables, one per operator family of the
survey's inventory. Each takes ``(spark, sf_dir)`` and returns a DataFrame
computed over whole tables. ``tablefit.plans.oracle`` holds the matching
DuckDB SQL; computed columns carry the same names and roundings there.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.functions.cells import category_value, typed_cell
from tablefit.functions.labels import label_column
from tablefit.functions.vectors import (abs_array, fill_nulls_array, l1_abs_normalize,
                                        lp_normalize, signed_max_normalize)
from tablefit.operators.exclude import exclude_columns
from tablefit.operators.metrics import regression_metrics
from tablefit.operators.split import key_split
from tablefit.operators import trainers as tr
from tablefit.plans import model_run as mr
from tablefit.plans.tables import (LINEITEM_EXPRESSIONS, LINEITEM_FEATURES, LINEITEM_KEYS,
                                   LINEITEM_LABELS, RETURNFLAG_CATEGORIES, lineitem_matches,
                                   table)

DIGITS = 6


def _dealt(spark: SparkSession) -> int:
    """Partitions that the fits' rows are dealt into: lineitem may be one row group."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _persisted(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _r(c, digits: int = DIGITS):
    return F.round(c, digits)


# ---------------------------------------------------------------------------
# flagship: one fit end to end
# ---------------------------------------------------------------------------
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> RF label (drop_zero removes N) -> L2 rows -> components
    -> L1 |x| features -> key split 70/30 -> naive Bayes -> one metric row."""
    rows = lineitem_matches(spark, sf_dir)
    prep = mr.prepare(rows, ["RF"], LINEITEM_FEATURES, ["row_key"], k=3, confidence=0.999,
                      override_components=False, persist=False, partitions=_dealt(spark))
    try:
        report = mr.evaluate(prep, [("naive_bayes", "RF", 0, {})], digits=DIGITS, parallelism=1)
    finally:
        prep.unpersist()
    return report.select("trainer", "label_expr", "test_ratio", "n", "var", "mae", "mse",
                         "r2", "rmse")


QUERIES = {}


def query(fn):
    name = fn.__name__[:-2] if fn.__name__.endswith("_q") else fn.__name__
    QUERIES[name] = fn
    return fn


query(flagship)


# ---------------------------------------------------------------------------
# Projections and cell functions
# ---------------------------------------------------------------------------
LINEITEM_EXCLUDES = ["l_partkey", "l_suppkey", "l_shipdate", "l_comment", "l_shipmode"]


@query
def exclude_columns_q(spark, sf_dir):
    """Drop identity and date columns (absent names are ignored)."""
    return exclude_columns(table(spark, sf_dir, "lineitem"), LINEITEM_EXCLUDES)


def _cell_texts(li):
    return {
        "c_qty": F.col("l_quantity").cast("string"),
        "c_flag": F.col("l_returnflag"),
        "c_status": F.col("l_linestatus"),
        "c_padded": F.concat(F.lit(" "), F.col("l_linenumber").cast("string"), F.lit(" ")),
        "c_date": F.col("l_shipdate").cast("date").cast("string"),
        "c_blank": F.when(F.col("l_discount") == 0.0, F.lit("")).otherwise(
            F.col("l_discount").cast("string")),
        "c_price": F.col("l_extendedprice").cast("string"),
    }


@query
def typed_cells(spark, sf_dir):
    """P2 + P3: text cells -> number, category value or null."""
    li = table(spark, sf_dir, "lineitem")
    texts = _cell_texts(li)
    return li.select("l_orderkey", "l_linenumber",
                     *[typed_cell(t, RETURNFLAG_CATEGORIES).alias(n) for n, t in texts.items()])


@query
def category_map(spark, sf_dir):
    """Flags through their category tables."""
    li = lineitem_matches(spark, sf_dir)
    return li.select("l_orderkey", "l_linenumber", F.col("RF").alias("rf"), F.col("LS").alias("ls"))


# ---------------------------------------------------------------------------
# Headers that differ by season
# ---------------------------------------------------------------------------
@query
def schema_union(spark, sf_dir):
    """U1 + U2: three year groups with different columns stacked by name."""
    from tablefit.operators.align import merged_titles_from_headers, union_by_name
    from tablefit.plans.tables import lineitem_year_groups
    groups = lineitem_year_groups(spark, sf_dir)
    order = merged_titles_from_headers([h for h, _ in groups])
    return union_by_name([df for _, df in groups], order)


@query
def merged_order(spark, sf_dir):
    """U2 over the inventory of season files cut from lineitem."""
    from tablefit.operators.align import title_order
    from tablefit.plans.tables import lineitem_inventory
    return title_order(lineitem_inventory(spark, sf_dir))


@query
def header_coverage(spark, sf_dir):
    """Files per title."""
    from tablefit.operators.align import header_coverage as coverage
    from tablefit.plans.tables import lineitem_inventory
    return coverage(lineitem_inventory(spark, sf_dir))


@query
def unknown_columns(spark, sf_dir):
    """U4: titles missing from the catalogue, with their file counts."""
    from tablefit.operators.align import unknown_columns as unknown
    from tablefit.plans.tables import LINEITEM_CATALOGUE, lineitem_inventory
    return unknown(lineitem_inventory(spark, sf_dir), LINEITEM_CATALOGUE)


@query
def label_prefix_check(spark, sf_dir):
    """does each file's header start with the label block?"""
    from tablefit.operators.checks import label_prefix_report
    from tablefit.plans.tables import PREFIX_LABELS, lineitem_inventory
    rep = label_prefix_report(lineitem_inventory(spark, sf_dir), PREFIX_LABELS)
    return rep.select("file", F.array_join("actual", ",").alias("actual"), "ok")


# ---------------------------------------------------------------------------
# F1, F2, P4
# ---------------------------------------------------------------------------
@query
def drop_unusable_labels(spark, sf_dir):
    """discount and tax as labels; nulls and zeros drop the row."""
    from tablefit.operators.checks import drop_unusable_labels as f1
    li = table(spark, sf_dir, "lineitem")
    return f1(li, ["l_discount", "l_tax"]).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")


@query
def drop_empty_features(spark, sf_dir):
    """discount and tax as features; all null/zero drops the row."""
    from tablefit.operators.checks import drop_empty_features as f2
    li = table(spark, sf_dir, "lineitem")
    return f2(li, ["l_discount", "l_tax"]).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")


@query
def label_expression(spark, sf_dir):
    """A label from a text expression over column names."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     _r(label_column("l_tax - l_discount", li.columns)).alias("label"))


# ---------------------------------------------------------------------------
# P5, P6, V1-V3 on embeddings (long form: one row per element)
# ---------------------------------------------------------------------------
def _long(df, arr, keep, sparse=False):
    out = df.select(*[F.col(k) for k in keep], F.posexplode(arr).alias("idx", "value"))
    if sparse:
        out = out.where(F.col("value") != 0.0)
    return out.select(*keep, "idx", _r(F.col("value")).alias("value"))


@query
def null_fill_abs(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return _long(emb, abs_array(fill_nulls_array("embedding")), ["vec_id"])


@query
def norm_l2(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return _long(emb, lp_normalize("embedding", 2.0), ["vec_id"])


@query
def norm_l1_abs(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return _long(emb, l1_abs_normalize("embedding"), ["vec_id"], sparse=True)


@query
def norm_max(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return _long(emb, signed_max_normalize("embedding"), ["vec_id"])


@query
def labelled_rows(spark, sf_dir):
    """P7 + P8 + V3: label and sparse L1 |x| features per lineitem row."""
    from tablefit.functions.vectors import feature_array
    li = lineitem_matches(spark, sf_dir)
    rows = li.select("l_orderkey", "l_linenumber", F.col("RF").alias("label"),
                     l1_abs_normalize(feature_array(LINEITEM_FEATURES)).alias("x"))
    return _long(rows, F.col("x"), ["l_orderkey", "l_linenumber", "label"], sparse=True)


# ---------------------------------------------------------------------------
# A1, O1-O3, M1
# ---------------------------------------------------------------------------
TWO_FEATURES = ["l_quantity", "q_plus"]


def _two_feature_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn(
        "q_plus", F.col("l_quantity") + F.col("l_discount") * F.lit(10.0))
    return mr.normalised_rows(li, [], TWO_FEATURES, LINEITEM_KEYS, filter_rows=False)


@query
def correlation_matrix(spark, sf_dir):
    """A1: Pearson matrix of the four L2-normalised lineitem features."""
    from tablefit.operators.components import correlation_long, correlation_matrix as corr
    li = table(spark, sf_dir, "lineitem")
    rows = _persisted(mr.normalised_rows(li, [], LINEITEM_FEATURES, filter_rows=False))
    matrix = corr(rows, "x")
    rows.unpersist()
    return correlation_long(spark, matrix, LINEITEM_FEATURES, DIGITS)


@query
def components_two(spark, sf_dir):
    """M1 + O1 + O2: two correlated features, both components per row."""
    from tablefit.operators.components import fit_components
    rows = _persisted(_two_feature_rows(spark, sf_dir))
    comps = fit_components(rows, "x", TWO_FEATURES, k=2, confidence=0.999)
    rows.unpersist()
    out = comps.project(rows, "x", LINEITEM_KEYS)
    return out.select(*LINEITEM_KEYS, _r(F.col("Comp1")).alias("Comp1"),
                      _r(F.col("Comp2")).alias("Comp2"))


@query
def components_for_confidence(spark, sf_dir):
    """O3: explained ratios, cumulative sums and the selected count."""
    from tablefit.operators.components import fit_components
    rows = _persisted(_two_feature_rows(spark, sf_dir))
    comps = fit_components(rows, "x", TWO_FEATURES, k=1, confidence=0.95,
                           override_components=True)
    rows.unpersist()
    return comps.explained(spark, DIGITS)


@query
def components_norm(spark, sf_dir):
    """M1 at full rank keeps each row's L2 norm (64 embedding features)."""
    from tablefit.operators.components import fit_components
    emb = table(spark, sf_dir, "embeddings")
    rows = _persisted(emb.select("vec_id", lp_normalize("embedding", 2.0).alias("x")))
    d = 64
    names = [f"e{i}" for i in range(d)]
    comps = fit_components(rows, "x", names, k=d, confidence=0.999)
    rows.unpersist()
    proj = comps.project(rows, "x", ["vec_id"])
    sq = None
    for j in range(comps.k):
        c = F.col(f"Comp{j + 1}")
        sq = c * c if sq is None else sq + c * c
    return proj.select("vec_id", _r(F.sqrt(sq)).alias("norm"))


# ---------------------------------------------------------------------------
# M2, A2, A3
# ---------------------------------------------------------------------------
@query
def split_ratio(spark, sf_dir):
    from tablefit.operators.split import split_counts
    orders = table(spark, sf_dir, "orders")
    return split_counts(key_split(orders.select("o_orderkey"), ["o_orderkey"], 0.3))


@query
def split_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return key_split(orders.select("o_orderkey"), ["o_orderkey"], 0.3)


@query
def regression_metrics_q(spark, sf_dir):
    """A3 per (returnflag, linestatus): price/1000 scored against quantity."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus",
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("prediction"),
        F.col("l_quantity").alias("label"))
    return regression_metrics(li, "prediction", "label", ["l_returnflag", "l_linestatus"], DIGITS)


# ---------------------------------------------------------------------------
# Fits with closed forms
# ---------------------------------------------------------------------------
def _one_feature(spark, sf_dir):
    from tablefit.functions.vectors import to_vector
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LINEITEM_KEYS,
                     to_vector(F.array(F.col("l_quantity") / F.lit(10.0))).alias("features"),
                     (F.col("l_extendedprice") / F.lit(10000.0)).alias("label"))


def _coefficient_frame(spark, name, fitted):
    coef = fitted.coefficients()
    return spark.createDataFrame([(name, round(coef[0], DIGITS))], "trainer string, coefficient double")


@query
def linear_fit(spark, sf_dir):
    data = _one_feature(spark, sf_dir)
    return _coefficient_frame(spark, "linear", tr.fit("linear", data))


@query
def ridge_fit(spark, sf_dir):
    data = _one_feature(spark, sf_dir)
    return _coefficient_frame(spark, "ridge", tr.fit("ridge", data))


@query
def lasso_fit(spark, sf_dir):
    data = _one_feature(spark, sf_dir)
    exact = {"convergenceTol": 1e-10}  # six digits are compared
    return _coefficient_frame(spark, "lasso", tr.fit("lasso", data, override=exact))


@query
def linear_predictions(spark, sf_dir):
    """Predictions of the no-intercept linear fit for every row."""
    data = _one_feature(spark, sf_dir)
    fitted = tr.fit("linear", data)
    return fitted.predict(data).select(*LINEITEM_KEYS, _r(F.col("prediction")).alias("prediction"))


NB_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@query
def naive_bayes_fit(spark, sf_dir):
    """M6 + Q7: class priors and feature log-probabilities per label value
    (labels indexed, then decoded back)."""
    from tablefit.functions.vectors import feature_array, to_vector
    li = lineitem_matches(spark, sf_dir)
    data = li.select(to_vector(feature_array(NB_FEATURES)).alias("features"),
                     F.col("RF").alias("label"))
    fitted = tr.fit("naive_bayes", data)
    nb = fitted.model.stages[1]
    labels = [float(x) for x in fitted.model.stages[0].labelsArray[0]]
    pi = nb.pi.toArray()
    theta = nb.theta.toArray()
    rows = []
    for c, lab in enumerate(labels):
        rows.append((lab, "_prior", round(float(pi[c]), DIGITS)))
        for j, name in enumerate(NB_FEATURES):
            rows.append((lab, name, round(float(theta[c, j]), DIGITS)))
    return spark.createDataFrame(rows, "label double, feature string, log_prob double")


# ---------------------------------------------------------------------------
# Fits without a closed form (rows-only checks)
# ---------------------------------------------------------------------------
def _prepared(spark, sf_dir, labels, drop_zero=True):
    li = lineitem_matches(spark, sf_dir)
    return mr.prepare(li, labels, LINEITEM_FEATURES, ["row_key"] + LINEITEM_KEYS, k=4,
                      confidence=0.999, drop_zero=drop_zero, persist=False, partitions=_dealt(spark))


def _test_predictions(prep, trainer, expression):
    data = prep.rows.select(*LINEITEM_KEYS, "features", "is_test",
                            label_column(expression).alias("label"))
    try:
        fitted = tr.fit(trainer, data.where(~F.col("is_test")), optimizer="newton")
    finally:
        prep.unpersist()  # the predictions read the input
    return fitted.predict(data.where(F.col("is_test"))).select(
        *LINEITEM_KEYS, "label", F.col("prediction").cast("double").alias("prediction"))


@query
def logistic_fit(spark, sf_dir):
    return _test_predictions(_prepared(spark, sf_dir, ["RF"]), "logistic", "RF")


@query
def multinomial_fit(spark, sf_dir):
    return _test_predictions(_prepared(spark, sf_dir, ["RF"], drop_zero=False),
                             "multinomial", "RF")


@query
def svm_fit(spark, sf_dir):
    return _test_predictions(_prepared(spark, sf_dir, ["RF", "LS"]), "svm", "RF * LS")


def _one_hot_rows(spark, sf_dir):
    """Features: one indicator per return flag; label: line status (F=1, O=-1).
    Without an intercept every indicator is fitted on its own, so the
    classifiers have closed forms."""
    from tablefit.functions.vectors import to_vector
    li = lineitem_matches(spark, sf_dir)
    flags = [F.when(F.col("RF") == v, 1.0).otherwise(0.0) for v in (1.0, 0.0, -1.0)]
    return li.select(to_vector(F.array(*flags)).alias("features"), F.col("LS").alias("label"))


def _one_hot_frame(spark, fitted, digits):
    names = ["R", "N", "A"]
    rows = [(n, round(c, digits)) for n, c in zip(names, fitted.coefficients())]
    return spark.createDataFrame(rows, "flag string, coefficient double")


@query
def logistic_one_hot(spark, sf_dir):
    """M3 without the L2 term: the log odds of each flag."""
    exact = {"regParam": 0.0, "convergenceTol": 1e-12}
    return _one_hot_frame(spark, tr.fit("logistic", _one_hot_rows(spark, sf_dir), override=exact), 4)


@query
def svm_one_hot(spark, sf_dir):
    """M5 where no margin reaches 1 (the flags hardly tell the status): share of the
    flag's rows times (2p - 1) over the L2 weight."""
    exact = {"regParam": 0.01, "convergenceTol": 1e-12}
    return _one_hot_frame(spark, tr.fit("svm", _one_hot_rows(spark, sf_dir), override=exact), 6)


@query
def multinomial_one_hot(spark, sf_dir):
    """M4 without the L2 term: with one indicator per line status the class
    probabilities are the shares of the return flags within the status."""
    from tablefit.functions.vectors import to_vector
    li = lineitem_matches(spark, sf_dir)
    states = [F.when(F.col("LS") == v, 1.0).otherwise(0.0) for v in (1.0, -1.0)]
    data = li.select("LS", to_vector(F.array(*states)).alias("features"), F.col("RF").alias("label"))
    exact = {"regParam": 0.0, "tolerance": 1e-12}
    fitted = tr.fit("multinomial", data, override=exact)
    scored = fitted.estimator_model.transform(data.select("LS", "features").distinct())
    share = F.posexplode(vector_to_array(F.col("probability"))).alias("class", "probability")
    labels = F.array(*[F.lit(v) for v in fitted.labels])
    return scored.select("LS", share).select(
        F.col("LS").alias("ls"), F.get(labels, F.col("class")).alias("label"),
        _r(F.col("probability"), 4).alias("probability"))


@query
def isotonic_fit(spark, sf_dir):
    from tablefit.functions.vectors import to_vector
    li = table(spark, sf_dir, "lineitem")
    data = li.select(*LINEITEM_KEYS, to_vector(F.array(F.col("l_quantity"))).alias("features"),
                     (F.col("l_extendedprice") / F.lit(1000.0)).alias("label"))
    fitted = tr.fit("isotonic", data)
    return fitted.predict(data).select(*LINEITEM_KEYS, _r(F.col("label")).alias("label"),
                                       _r(F.col("prediction")).alias("prediction"))


def _report_frame(report):
    return report.select("trainer", "label_expr", "param_set",
                         F.to_json("params").alias("params"), "test_ratio", "n",
                         *[_r(F.col(c)).alias(c) for c in ["var", "mae", "mse", "r2", "rmse"]])


@query
def parameter_sweep(spark, sf_dir):
    """M14 + M15: 4 label expressions x (4 logistic + 15 naive Bayes + 4 SVM
    parameter sets) = 92 fits over the whole lineitem table."""
    li = lineitem_matches(spark, sf_dir)
    report = mr.run_sweep(li, LINEITEM_LABELS, LINEITEM_FEATURES, ["row_key"],
                          expressions=LINEITEM_EXPRESSIONS, k=4, parallelism=8,
                          partitions=_dealt(spark))
    return _report_frame(report)


@query
def bayes_sweep(spark, sf_dir):
    """M2, M6, M14, M15, A3 in one chain that SQL can follow: filters, L1
    features without components, the integer-key split, 4 label expressions
    x 15 smoothing values, metrics of every fit on the held-out rows."""
    li = lineitem_matches(spark, sf_dir)
    report = mr.run_sweep(li, LINEITEM_LABELS, LINEITEM_FEATURES, ["l_orderkey"],
                          trainers=["naive_bayes"], expressions=LINEITEM_EXPRESSIONS,
                          use_components=False, partitions=_dealt(spark))
    return report.select("label_expr", "param_set", "n", _r(F.col("test_ratio")).alias("test_ratio"),
                         *[_r(F.col(c)).alias(c) for c in ["var", "mae", "mse", "r2", "rmse"]])


@query
def regression_sweep(spark, sf_dir):
    """M7-M10 in the sweep: linear, ridge, lasso and isotonic per label
    expression, scored on the held-out rows."""
    li = lineitem_matches(spark, sf_dir)
    report = mr.run_sweep(li, LINEITEM_LABELS, LINEITEM_FEATURES, ["row_key"],
                          trainers=["linear", "ridge", "lasso", "isotonic"],
                          expressions=LINEITEM_EXPRESSIONS, k=4, parallelism=8,
                          partitions=_dealt(spark))
    return _report_frame(report)


# ---------------------------------------------------------------------------
# S1-S7 end to end: season CSV files with differing headers, collated
# ---------------------------------------------------------------------------
def _collated_lineitem(spark, sf_dir):
    from tablefit.session import scratch_dir
    from tablefit.sources.csv_tables import collate
    from tablefit.plans.tables import (CSV_EXCLUDES, CSV_TEMPLATE, LINEITEM_CATALOGUE,
                                       season_years, write_lineitem_seasons)
    root = write_lineitem_seasons(spark, sf_dir, scratch_dir(spark, "lineitem-seasons"))
    first, last = season_years(spark, root)
    return collate(spark, root, first, last + 1, CSV_EXCLUDES,
                   RETURNFLAG_CATEGORIES, CSV_TEMPLATE, key_col=None,
                   catalogue=LINEITEM_CATALOGUE + ["net_price"])


@query
def collate_csv(spark, sf_dir):
    """Write lineitem as season CSV files with three
    header layouts, then read every season back through the header
    inventory, one CSV scan per distinct header, exclusions, typed cells and
    the by-name union."""
    return _collated_lineitem(spark, sf_dir).table


@query
def collate_dirty_csv(spark, sf_dir):
    """S4-S6, P2, P5's nulls: season files with trailing header commas, quoted
    commas, short, long and blank cells, two layouts; rows without a ship
    date lie in the last season."""
    from tablefit.session import scratch_dir
    from tablefit.sources.csv_tables import collate
    from tablefit.plans.tables import CSV_TEMPLATE, season_years, write_dirty_seasons
    root = write_dirty_seasons(spark, sf_dir, scratch_dir(spark, "dirty-seasons"))
    first, last = season_years(spark, root)
    return collate(spark, root, first, last + 1, ["note"],
                   RETURNFLAG_CATEGORIES, CSV_TEMPLATE, key_col=None, glob="*.txt").table


@query
def collated_season_scan(spark, sf_dir):
    """S7 + S9 + S1: store the collated table as Parquet partitioned by
    start_year, then scan only the seasons 1997-1999 (partition pruning)."""
    from tablefit.session import scratch_dir
    from tablefit.sources.tables import read_table, write_table
    col = _collated_lineitem(spark, sf_dir)
    path = write_table(col.table, scratch_dir(spark, "collated"))
    return read_table(spark, path, 1997, 2000)


@query
def main_run_csv(spark, sf_dir):
    """Section 3.1 end to end on season CSV files cut from lineitem:
    collate -> label-prefix check -> filters -> components -> 92 fits."""
    from tablefit.session import scratch_dir
    from tablefit.plans.main_run import main_run
    from tablefit.plans.tables import CSV_EXCLUDES, CSV_TEMPLATE, season_years, write_lineitem_seasons
    root = write_lineitem_seasons(spark, sf_dir, scratch_dir(spark, "lineitem-seasons"))
    first, last = season_years(spark, root)
    res = main_run(spark, root, first, last + 1,
                   labels=["l_orderkey", "l_linenumber"],
                   expressions=["l_linenumber - 4", "4 - l_linenumber",
                                "l_linenumber % 3 - 1", "l_linenumber % 2 * 2 - 1"],
                   k=None, confidence=0.95, exc_handicap=False, exc_averages=False,
                   exc_2_5_goals=False, extra_excludes=CSV_EXCLUDES,
                   categories=RETURNFLAG_CATEGORIES, template=CSV_TEMPLATE,
                   catalogue=None)
    return _report_frame(res.report)


@query
def sgd_fit(spark, sf_dir):
    """Logistic regression with the SGD optimiser and its step /
    mini-batch / tolerance settings (legacy RDD trainer, opt-in), scored on
    the held-out rows."""
    from tablefit.operators.sgd import fit_sgd
    prep = _prepared(spark, sf_dir, ["RF"])
    data = prep.rows.select(*LINEITEM_KEYS, "features", "is_test",
                            label_column("RF").alias("label"))
    try:
        fitted = fit_sgd("logistic", data.where(~F.col("is_test")))
    finally:
        prep.unpersist()
    return fitted.predict(data.where(F.col("is_test"))).select(
        *LINEITEM_KEYS, "label", "prediction")


@query
def components_sink(spark, sf_dir):
    """S8 + S9: labels and components written as a Parquet table, read back."""
    from tablefit.operators.components import fit_components
    from tablefit.session import scratch_dir
    from tablefit.sources.tables import read_table, write_components
    li = table(spark, sf_dir, "lineitem").withColumn(
        "q_plus", F.col("l_quantity") + F.col("l_discount") * F.lit(10.0)).withColumn(
        "RF", category_value("l_returnflag", RETURNFLAG_CATEGORIES))
    rows = _persisted(mr.normalised_rows(li, ["RF"], TWO_FEATURES, LINEITEM_KEYS,
                                        filter_rows=False))
    comps = fit_components(rows, "x", TWO_FEATURES, k=2, confidence=0.999)
    projected = comps.project(rows, "x", LINEITEM_KEYS + ["RF"])
    path = write_components(projected, scratch_dir(spark, "components"),
                            LINEITEM_KEYS + ["RF"], comps.k, partition_by=())
    rows.unpersist()
    back = read_table(spark, path)
    return back.select(*LINEITEM_KEYS, F.col("RF").alias("rf"),
                       _r(F.col("Comp1")).alias("Comp1"), _r(F.col("Comp2")).alias("Comp2"))


@query
def metric_report(spark, sf_dir):
    """M15 with the reference's scoring: the main-run sweep with predictions
    scored against the raw label values (score_against="raw") instead of
    the encoded classes."""
    li = lineitem_matches(spark, sf_dir)
    report = mr.run_sweep(li, LINEITEM_LABELS, LINEITEM_FEATURES, ["row_key"],
                          expressions=LINEITEM_EXPRESSIONS, k=4, parallelism=8,
                          score_against="raw", partitions=_dealt(spark))
    return _report_frame(report)


@query
def season_pruned_csv(spark, sf_dir):
    """S1 on raw files: only the season folders of 1997-1999 are listed and
    read (the other seasons' files are never opened)."""
    from tablefit.session import scratch_dir
    from tablefit.sources.csv_tables import collate
    from tablefit.plans.tables import (CSV_EXCLUDES, CSV_TEMPLATE, LINEITEM_CATALOGUE,
                                       write_lineitem_seasons)
    root = write_lineitem_seasons(spark, sf_dir, scratch_dir(spark, "lineitem-seasons"))
    col = collate(spark, root, 1997, 2000, CSV_EXCLUDES, RETURNFLAG_CATEGORIES, CSV_TEMPLATE,
                  key_col=None, catalogue=LINEITEM_CATALOGUE + ["net_price"])
    return col.table


# ---------------------------------------------------------------------------
# U2-U4, F3 on the headers of written files
# ---------------------------------------------------------------------------
def _written_inventory(spark, sf_dir):
    """The stored header inventory of lineitem's season files, all titles kept."""
    from tablefit.session import scratch_dir
    from tablefit.sources.csv_tables import stored_inventory
    from tablefit.sources.seasons import seasons
    from tablefit.plans.tables import CSV_TEMPLATE, season_years, write_lineitem_seasons
    root = write_lineitem_seasons(spark, sf_dir, scratch_dir(spark, "lineitem-seasons"))
    first, last = season_years(spark, root)
    wanted = [s for s in seasons(root, first, last + 1, CSV_TEMPLATE)]
    return stored_inventory(spark, wanted)


@query
def csv_title_order(spark, sf_dir):
    """S3 + U2: merged title order of the headers read from written files."""
    from tablefit.operators.align import title_order
    return title_order(_written_inventory(spark, sf_dir))


@query
def csv_unknown_columns(spark, sf_dir):
    """S3 + U3 + U4: titles of written files missing from the catalogue, with the
    seasons whose files carry them (the number of files is the writer's choice)."""
    from tablefit.operators.align import unknown_columns as unknown
    from tablefit.plans.tables import LINEITEM_CATALOGUE
    by_season = _written_inventory(spark, sf_dir).select("season", "start_year", "header").distinct()
    inventory = by_season.withColumn("file", F.col("season"))
    return unknown(inventory, [c for c in LINEITEM_CATALOGUE if c != "l_tax"]).withColumnRenamed("n_files", "n_seasons")


@query
def csv_label_prefix(spark, sf_dir):
    """S3 + F3: which seasons' files start with the label block?"""
    from tablefit.operators.checks import label_prefix_report
    from tablefit.plans.tables import PREFIX_LABELS
    inv = _written_inventory(spark, sf_dir)
    rep = label_prefix_report(inv, PREFIX_LABELS[:2])
    seasons_of = inv.select("file", "start_year")
    return rep.join(seasons_of, "file").select("start_year", F.array_join("actual", ",").alias("actual"), "ok").distinct()


@query
def null_fill_features(spark, sf_dir):
    """P5 + P6 on cells that are null: zero discounts and taxes taken as missing."""
    li = table(spark, sf_dir, "lineitem")
    cells = F.array(F.col("l_quantity"), F.expr("nullif(l_discount, 0.0)"), -F.expr("nullif(l_tax, 0.0)"))
    return _long(li.select(*LINEITEM_KEYS, cells.alias("cells")), abs_array(fill_nulls_array("cells")), LINEITEM_KEYS)


# ---------------------------------------------------------------------------
# Fits from shared passes
# ---------------------------------------------------------------------------
@query
def least_squares_fits(spark, sf_dir):
    """M7, M8 with several features: coefficients from one pass of sums."""
    from tablefit.functions.vectors import to_vector
    from tablefit.operators.blocks import to_blocks
    from tablefit.operators.least_squares import fit_least_squares, moments
    li = table(spark, sf_dir, "lineitem")
    x = to_vector(F.array(F.col("l_quantity") / 10.0, F.col("l_discount") * 10.0))
    blocks = to_blocks(li.select(x.alias("features"), (F.col("l_extendedprice") / 10000.0).alias("y")),
                       "features", {"y": F.col("y")}, persist=False)
    models = fit_least_squares(moments(blocks)[0], [(t, tr.trainer_params(t)) for t in ("linear", "ridge")])
    rows = [(m.name, name, round(c, 5)) for m in models for name, c in zip(["l_quantity", "l_discount"], m.coefficients())]
    return spark.createDataFrame(rows, "trainer string, feature string, coefficient double")


@query
def least_squares_sweep(spark, sf_dir):
    """M2, M7, M8, M14, M15, A3 in one chain that SQL can follow: linear and
    ridge over 4 label expressions, two L1 features, scored on held-out rows."""
    li = lineitem_matches(spark, sf_dir)
    report = mr.run_sweep(li, LINEITEM_LABELS, LINEITEM_FEATURES[:2], ["l_orderkey"],
                          trainers=["linear", "ridge"], expressions=LINEITEM_EXPRESSIONS,
                          use_components=False, partitions=_dealt(spark))
    return report.select("trainer", "label_expr", "n", _r(F.col("test_ratio")).alias("test_ratio"),
                         *[_r(F.col(c), 5).alias(c) for c in ["var", "mae", "mse", "r2", "rmse"]])


@query
def optimal_fits(spark, sf_dir):
    """M3, M5 with the configured L2 penalties: every distinct fit of the main
    run's lists, its rows, and whether the duality gap proves it optimal to
    1e-4 of its objective."""
    from tablefit.operators.blocks import label_sets, to_blocks
    from tablefit.operators.gradient import Spec, fit_optimal
    li = lineitem_matches(spark, sf_dir)
    prep = mr.prepare(li, LINEITEM_LABELS, LINEITEM_FEATURES, ["l_orderkey"], use_components=False,
                      persist=False, partitions=_dealt(spark))
    label_of = label_sets(LINEITEM_EXPRESSIONS)
    blocks = to_blocks(prep.rows, "features", {e: label_column(e, prep.rows.columns) for e in label_of}, F.col("is_test"))
    specs = [Spec(t, i, {**tr.trainer_params(t), "regParam": r})
             for t in ("logistic", "svm") for i in label_of.values() for r in (0.01, 0.005)]
    results = fit_optimal(blocks, specs, gap=1e-4)
    trained = prep.rows.where(~F.col("is_test")).count()
    blocks.unpersist()
    rows = [(r.spec.name, LINEITEM_EXPRESSIONS[r.spec.label], float(r.spec.params["regParam"]), trained,
             bool(0 <= r.gap + 1e-12 and r.gap <= 1e-4 * r.value)) for r in results]
    return spark.createDataFrame(rows, "trainer string, label_expr string, penalty double, n long, proven boolean")


@query
def isotonic_blocks(spark, sf_dir):
    """M10 by range partitions: the blocks of price against quantity, each
    with its fitted value and rows (neighbours of one value as one)."""
    from tablefit.operators.isotonic import fit_isotonic
    li = table(spark, sf_dir, "lineitem")
    fitted = fit_isotonic(li, F.col("l_quantity"), F.col("l_extendedprice") / 1000.0).fitted()
    return (fitted.groupBy(_r(F.col("value"), 4).alias("fitted"))
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("weight").cast("long").alias("n")))


@query
def repair_report(spark, sf_dir):
    """Rows, short, long and blank rows per season of the dirty files,
    counted while they are parsed."""
    from tablefit.session import scratch_dir
    from tablefit.sources.csv_tables import collate
    from tablefit.plans.tables import CSV_TEMPLATE, season_years, write_dirty_seasons
    root = write_dirty_seasons(spark, sf_dir, scratch_dir(spark, "dirty-seasons"))
    first, last = season_years(spark, root)
    col = collate(spark, root, first, last + 1, ["note", "l_orderkey", "l_linenumber"], RETURNFLAG_CATEGORIES,
                  CSV_TEMPLATE, key_col=None, glob="*.txt", report=True)
    col.table.write.format("noop").mode("overwrite").save()
    return col.repair_report()


@query
def drop_report(spark, sf_dir):
    """F1 + F2: how many rows the label and the feature filter drop."""
    from tablefit.operators.checks import observed_filters
    kept, seen = observed_filters(table(spark, sf_dir, "lineitem"), ["l_discount"], ["l_tax"])
    kept.write.format("noop").mode("overwrite").save()
    names = ["n_rows", "n_unlabelled", "n_featureless", "n_kept"]
    return spark.createDataFrame([tuple(int(seen.get[c]) for c in names)], ", ".join(f"{c} long" for c in names))


@query
def components_range(spark, sf_dir):
    """M1 + O1 without the d x d matrix: the leading component of two features."""
    from tablefit.operators.range_components import fit_range_components
    rows = _two_feature_rows(spark, sf_dir)
    comps = fit_range_components(rows, "x", TWO_FEATURES, k=1)
    return comps.project(rows, "x", LINEITEM_KEYS).select(*LINEITEM_KEYS, _r(F.col("Comp1")).alias("Comp1"))
