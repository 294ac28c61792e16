"""Property test: the typed-cell rule against a plain statement of it."""

import re

from hypothesis import given, settings, strategies as st

from tablefit.functions.cells import typed_cell
from tablefit.functions.fixed import NUMBER_PATTERN, RESULT_CATEGORIES

_NUM = re.compile(NUMBER_PATTERN)


def expected(text):
    if text is None:
        return None
    t = text.strip(" ")
    if _NUM.fullmatch(t):
        return float(t)
    return RESULT_CATEGORIES.get(t)


cells = st.one_of(
    st.none(),
    st.sampled_from(["H", "D", "A", " H ", "h", "", "  ", "NaN", "1d", "1e", ".", "+", "-0"]),
    st.from_regex(r"\A ?[+-]?[0-9]{1,6}(\.[0-9]{0,4})?([eE][+-]?[0-9]{1,2})? ?\Z"),
    st.text(alphabet="0123456789.eE+- HDAx", max_size=8),
)


@settings(max_examples=1, deadline=None)
@given(st.lists(cells, min_size=200, max_size=200))
def test_typed_cell_matches_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(typed_cell("t")).collect()]
    assert got == [expected(t) for t in texts]


from tablefit.functions.vectors import l1_abs_normalize, lp_normalize, signed_max_normalize  # noqa: E402

arrays = st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False),
                            st.just(0.0)), min_size=1, max_size=8)


@settings(max_examples=1, deadline=None)
@given(st.lists(arrays, min_size=100, max_size=100))
def test_normalised_rows_have_unit_norm(spark, rows):
    import math
    df = spark.createDataFrame([(r,) for r in rows], "a array<double>")
    out = df.select(lp_normalize("a", 2.0).alias("l2"), l1_abs_normalize("a").alias("l1"),
                    signed_max_normalize("a").alias("mx")).collect()
    for src, r in zip(rows, out):
        vals = [0.0 if v is None else v for v in src]
        if any(v != 0.0 for v in vals):
            assert math.isclose(sum(v * v for v in r["l2"]), 1.0, rel_tol=1e-9)
            assert math.isclose(sum(r["l1"]), 1.0, rel_tol=1e-9)
            assert all(v >= 0.0 for v in r["l1"])
        else:
            assert all(v == 0.0 for v in r["l2"]) and all(v == 0.0 for v in r["l1"])
        top = max(vals)
        if top > 0:
            assert max(r["mx"]) == 1.0
        elif top == 0:
            assert all(v is None for v in r["mx"])
