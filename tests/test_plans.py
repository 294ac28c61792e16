"""Physical-plan properties that matter at scale."""

from conftest import SF001
from tablefit.plans.queries import QUERIES
from tablefit.plans.tables import CSV_EXCLUDES, CSV_TEMPLATE, RETURNFLAG_CATEGORIES, write_lineitem_seasons
from tablefit.session import scratch_dir
from tablefit.sources.csv_tables import collate, header_inventory
from tablefit.sources.seasons import seasons


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(QUERIES["drop_unusable_labels"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_discount), Not(EqualTo(l_discount,0.0))" in plan
    assert "l_shipdate" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_projection_prunes_the_scan(spark):
    plan = _plan(QUERIES["exclude_columns"](spark, SF001))
    read = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "l_partkey" not in read and "l_suppkey" not in read and "l_shipdate" not in read


def test_season_range_prunes_partitions(spark):
    plan = _plan(QUERIES["collated_season_scan"](spark, SF001))
    assert "PartitionFilters: [isnotnull(start_year" in plan
    assert "(start_year#" in plan and ">= 1997" in plan


def test_one_csv_scan_per_distinct_header_and_no_sort(spark):
    root = write_lineitem_seasons(spark, SF001, scratch_dir(spark, "plan-seasons"))
    col = collate(spark, root, 1995, 2002, CSV_EXCLUDES, RETURNFLAG_CATEGORIES, CSV_TEMPLATE,
                  key_col=None)
    n_files = col.inventory.count()
    n_headers = col.inventory.select("raw_header").distinct().count()
    plan = _plan(col.table)
    assert n_files > n_headers == 3
    assert plan.count("FileScan csv") == n_headers
    inv_plan = _plan(header_inventory(spark, seasons(root, 1995, 2002, CSV_TEMPLATE)))
    # headers are read from the files' starts: no scan of the text, no aggregate, no sort
    assert "BatchScan first_lines" in inv_plan
    assert not any(x in inv_plan for x in ("FileScan", "Aggregate", "Sort", "Exchange"))


def test_metrics_aggregate_partially_before_the_shuffle(spark):
    plan = _plan(QUERIES["regression_metrics"](spark, SF001))
    assert "partial_sum" in plan and plan.index("partial_sum") > plan.index("Exchange")


def test_empty_feature_filter_is_pushed(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(QUERIES["drop_empty_features"](spark, SF001))
    assert "PushedFilters: [Or(And(IsNotNull(l_discount),Not(EqualTo(l_discount,0.0)))" in plan


def test_season_groups_are_pushed(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(QUERIES["schema_union"](spark, SF001))
    assert "LessThan(l_shipdate,1997-01-01T00:00)" in plan
    assert "GreaterThanOrEqual(l_shipdate,1999-01-01T00:00)" in plan
