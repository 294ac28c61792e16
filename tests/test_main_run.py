"""The full run with its football defaults on seeded season files."""

from fixtures import write_football_seasons
from tablefit.functions.fixed import LABEL_EXPRESSIONS, LABELS
from tablefit.plans.main_run import main_run


def test_main_run_defaults(spark, tmpdir_path):
    root = write_football_seasons(tmpdir_path)
    res = main_run(spark, root, 2000, 2003, table_path=tmpdir_path + "/collated")
    titles = res.collated.titles
    assert titles[:6] == LABELS
    assert not any(t.startswith("Bb") or t in ("Div", "Referee", "HS") for t in titles)
    assert len(titles) == 6 + 8 * 3                      # 8 bookmakers x H/D/A
    rows = res.report.collect()
    assert len(rows) == 92
    assert {r["label_expr"] for r in rows} == set(LABEL_EXPRESSIONS)
    assert all(r["n"] and r["n"] > 0 for r in rows)
    assert all(0.0 < r["test_ratio"] < 1.0 for r in rows)
    # the stored table is partitioned by season start year
    back = spark.read.parquet(tmpdir_path + "/collated")
    assert {r[0] for r in back.select("start_year").distinct().collect()} == {2000, 2001, 2002}
