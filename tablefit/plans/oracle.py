"""DuckDB SQL equivalents of ``tablefit.plans.queries``: same column names,
types and roundings. Queries without an SQL equivalent (most iterative
fits and their sweeps) have no entry. The SQL text is assembled from the same fixed
values the Spark side uses.
"""

from __future__ import annotations

from tablefit.functions.fixed import NUMBER_PATTERN, TRAINER_OVERRIDES
from tablefit.plans.tables import (CSV_EARLY, CSV_EXCLUDES, CSV_LATE, CSV_MIDDLE, DIRTY_LAST_YEAR,
                                   EARLY_LAST_YEAR, HEADER_EARLY, HEADER_LATE, HEADER_MIDDLE,
                                   LINEITEM_CATALOGUE, LINEITEM_FEATURES, LINESTATUS_CATEGORIES,
                                   MIDDLE_LAST_YEAR, PREFIX_LABELS, RETURNFLAG_CATEGORIES)

ORACLE_SQL: dict[str, str] = {}


def _list(xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _category(text: str, table: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in table.items())
    return f"(CASE trim({text}) {whens} END)"


def _typed(text: str, table: dict) -> str:
    return (f"(CASE WHEN regexp_full_match(trim({text}), '{NUMBER_PATTERN}') "
            f"THEN CAST(trim({text}) AS DOUBLE) ELSE {_category(text, table)} END)")


RF = _category("l_returnflag", RETURNFLAG_CATEGORIES)
LS = _category("l_linestatus", LINESTATUS_CATEGORIES)

ORACLE_SQL["exclude_columns"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus
FROM lineitem"""

_TEXTS = {
    "c_qty": "CAST(l_quantity AS VARCHAR)",
    "c_flag": "l_returnflag",
    "c_status": "l_linestatus",
    "c_padded": "(' ' || CAST(l_linenumber AS VARCHAR) || ' ')",
    "c_date": "CAST(CAST(l_shipdate AS DATE) AS VARCHAR)",
    "c_blank": "(CASE WHEN l_discount = 0 THEN '' ELSE CAST(l_discount AS VARCHAR) END)",
    "c_price": "CAST(l_extendedprice AS VARCHAR)",
}
ORACLE_SQL["typed_cells"] = (
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"{_typed(t, RETURNFLAG_CATEGORIES)} AS {n}" for n, t in _TEXTS.items())
    + " FROM lineitem")

ORACLE_SQL["category_map"] = f"""
SELECT l_orderkey, l_linenumber, {RF} AS rf, {LS} AS ls FROM lineitem"""

_YEAR = "CAST(year(l_shipdate) AS INTEGER)"
ORACLE_SQL["schema_union"] = f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       CAST({_YEAR} AS DOUBLE) AS ship_year
FROM lineitem WHERE {_YEAR} <= {EARLY_LAST_YEAR}
UNION ALL BY NAME
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice, l_returnflag,
       l_linestatus
FROM lineitem WHERE {_YEAR} > {EARLY_LAST_YEAR} AND {_YEAR} <= {MIDDLE_LAST_YEAR}
UNION ALL BY NAME
SELECT l_orderkey, l_linenumber, l_tax, l_linestatus,
       l_extendedprice * (1.0 - l_discount) AS net_price
FROM lineitem WHERE l_shipdate IS NULL OR {_YEAR} > {MIDDLE_LAST_YEAR}"""

_INVENTORY = f"""
WITH files AS (
  SELECT DISTINCT {_YEAR} AS start_year, l_returnflag FROM lineitem),
inv AS (
  SELECT coalesce(CAST(start_year AS VARCHAR), 'none') || '/' || coalesce(l_returnflag, 'none')
           || '.csv' AS file,
         start_year,
         CASE WHEN start_year <= {EARLY_LAST_YEAR} THEN {_list(HEADER_EARLY)}
              WHEN start_year <= {MIDDLE_LAST_YEAR} THEN {_list(HEADER_MIDDLE)}
              ELSE {_list(HEADER_LATE)} END AS header
  FROM files)"""

ORACLE_SQL["merged_order"] = _INVENTORY + """,
lg AS (SELECT file FROM inv ORDER BY len(header) DESC, start_year NULLS FIRST, file LIMIT 1),
ex AS (
  SELECT CASE WHEN file = (SELECT file FROM lg) THEN 0 ELSE 1 END AS r0, start_year, file,
         unnest(header) AS title, unnest(range(len(header))) AS pos
  FROM inv),
fst AS (
  SELECT * FROM ex
  QUALIFY row_number() OVER (PARTITION BY title
                             ORDER BY r0, start_year NULLS FIRST, file, pos) = 1)
SELECT title,
       CAST(row_number() OVER (ORDER BY r0, start_year NULLS FIRST, file, pos) AS INTEGER)
         AS position
FROM fst"""

ORACLE_SQL["header_coverage"] = _INVENTORY + """
SELECT title, count(*) AS n_files
FROM (SELECT DISTINCT file, unnest(header) AS title FROM inv)
GROUP BY title"""

ORACLE_SQL["unknown_columns"] = _INVENTORY + f"""
SELECT title, count(*) AS n_files
FROM (SELECT DISTINCT file, unnest(header) AS title FROM inv)
WHERE title NOT IN ({", ".join(f"'{c}'" for c in LINEITEM_CATALOGUE)})
GROUP BY title"""

ORACLE_SQL["label_prefix_check"] = _INVENTORY + f"""
SELECT file, array_to_string(header[1:{len(PREFIX_LABELS)}], ',') AS actual,
       coalesce(header[1:{len(PREFIX_LABELS)}] = {_list(PREFIX_LABELS)}, false) AS ok
FROM inv"""

ORACLE_SQL["drop_unusable_labels"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
WHERE l_discount IS NOT NULL AND l_discount <> 0 AND l_tax IS NOT NULL AND l_tax <> 0"""

ORACLE_SQL["drop_empty_features"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
WHERE coalesce(l_discount, 0) <> 0 OR coalesce(l_tax, 0) <> 0"""

ORACLE_SQL["label_expression"] = """
SELECT l_orderkey, l_linenumber, round(l_tax - l_discount, 6) AS label FROM lineitem"""

_ELEMENTS = """
WITH u AS (
  SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS idx,
         unnest(embedding) AS v0
  FROM embeddings),
e AS (SELECT vec_id, idx, coalesce(CAST(v0 AS DOUBLE), 0.0) AS v FROM u)"""

ORACLE_SQL["null_fill_abs"] = _ELEMENTS + """
SELECT vec_id, idx, round(abs(v), 6) AS value FROM e"""

ORACLE_SQL["norm_l2"] = _ELEMENTS + """,
n AS (SELECT vec_id, sqrt(sum(v * v)) AS norm FROM e GROUP BY vec_id)
SELECT vec_id, idx, round(CASE WHEN norm = 0 THEN v ELSE v / norm END, 6) AS value
FROM e JOIN n USING (vec_id)"""

ORACLE_SQL["norm_l1_abs"] = _ELEMENTS + """,
n AS (SELECT vec_id, sum(abs(v)) AS norm FROM e GROUP BY vec_id)
SELECT vec_id, idx, round(abs(v) / norm, 6) AS value
FROM e JOIN n USING (vec_id) WHERE v <> 0"""

ORACLE_SQL["norm_max"] = _ELEMENTS + """,
n AS (SELECT vec_id, max(v) AS top FROM e GROUP BY vec_id)
SELECT vec_id, idx, round(CASE WHEN top = 0 THEN NULL ELSE v / top END, 6) AS value
FROM e JOIN n USING (vec_id)"""

_ABS = ", ".join(f"abs(coalesce(CAST({c} AS DOUBLE), 0.0)) AS a{i}"
                 for i, c in enumerate(LINEITEM_FEATURES))
_TOT = " + ".join(f"a{i}" for i in range(len(LINEITEM_FEATURES)))
ORACLE_SQL["labelled_rows"] = f"""
WITH r AS (SELECT l_orderkey, l_linenumber, {RF} AS label, {_ABS} FROM lineitem),
s AS (SELECT *, {_TOT} AS tot FROM r)
""" + "\nUNION ALL\n".join(
    f"SELECT l_orderkey, l_linenumber, label, CAST({i} AS INTEGER) AS idx, "
    f"round(a{i} / tot, 6) AS value FROM s WHERE a{i} <> 0"
    for i in range(len(LINEITEM_FEATURES)))


def _l2_rows(features, source, keys=()):
    xs = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS x{i}" for i, c in enumerate(features))
    ss = " + ".join(f"x{i} * x{i}" for i in range(len(features)))
    ns = ", ".join(f"CASE WHEN nrm = 0 THEN x{i} ELSE x{i} / nrm END AS n{i}"
                   for i in range(len(features)))
    k = "".join(f"{c}, " for c in keys)
    return (f"raw AS (SELECT {k}{xs} FROM {source}), "
            f"nr AS (SELECT *, sqrt({ss}) AS nrm FROM raw), "
            f"nx AS (SELECT {k}{ns} FROM nr)")


ORACLE_SQL["correlation_matrix"] = f"WITH {_l2_rows(LINEITEM_FEATURES, 'lineitem')}\n" + \
    "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j, '{a}' AS feature_i, "
        f"'{b}' AS feature_j, round(corr(n{i}, n{j}), 6) AS corr FROM nx"
        for i, a in enumerate(LINEITEM_FEATURES) for j, b in enumerate(LINEITEM_FEATURES))

_TWO_SOURCE = ("(SELECT l_orderkey, l_linenumber, l_quantity, "
               "l_quantity + l_discount * 10.0 AS q_plus FROM lineitem)")
_TWO = f"WITH {_l2_rows(['l_quantity', 'q_plus'], _TWO_SOURCE, ['l_orderkey', 'l_linenumber'])}"

ORACLE_SQL["components_two"] = _TWO + """,
r AS (SELECT sign(corr(n0, n1)) AS s FROM nx)
SELECT l_orderkey, l_linenumber,
       round(n0 * sqrt(0.5) + n1 * (s * sqrt(0.5)), 6) AS Comp1,
       round(n0 * sqrt(0.5) + n1 * (-s * sqrt(0.5)), 6) AS Comp2
FROM nx, r"""

ORACLE_SQL["components_for_confidence"] = _TWO + """,
r AS (SELECT abs(corr(n0, n1)) AS a FROM nx),
k AS (SELECT CASE WHEN (1 + a) / 2 > 0.95 THEN 1 ELSE 2 END AS kc FROM r)
SELECT CAST(1 AS INTEGER) AS component, round(1 + a, 6) AS eigenvalue,
       round((1 + a) / 2, 6) AS ratio, round((1 + a) / 2, 6) AS cumulative,
       true AS selected FROM r, k
UNION ALL
SELECT CAST(2 AS INTEGER), round(1 - a, 6), round((1 - a) / 2, 6), round(1.0, 6), kc >= 2
FROM r, k"""

ORACLE_SQL["components_norm"] = _ELEMENTS + """,
n AS (SELECT vec_id, sqrt(sum(v * v)) AS norm FROM e GROUP BY vec_id),
x AS (SELECT vec_id, CASE WHEN norm = 0 THEN v ELSE v / norm END AS w FROM e JOIN n USING (vec_id))
SELECT vec_id, round(sqrt(sum(w * w)), 6) AS norm FROM x GROUP BY vec_id"""

_SPLIT = ("(CAST(((o_orderkey % 2147483647) * 1103515245 + 12345) % 2147483647 AS DOUBLE)"
          " / CAST(2147483647 AS DOUBLE) < 0.3)")
ORACLE_SQL["split_ratio"] = f"""
WITH s AS (SELECT {_SPLIT} AS t FROM orders)
SELECT count(*) AS n_total, CAST(sum(CASE WHEN t THEN 1 ELSE 0 END) AS BIGINT) AS n_test,
       round(sum(CASE WHEN t THEN 1 ELSE 0 END) / count(*), 6) AS test_ratio
FROM s"""

ORACLE_SQL["split_rows"] = f"SELECT o_orderkey, {_SPLIT} AS is_test FROM orders"

ORACLE_SQL["regression_metrics"] = """
WITH d AS (SELECT l_returnflag, l_linestatus, l_extendedprice / 1000.0 AS p, l_quantity AS y,
                  avg(l_quantity) OVER (PARTITION BY l_returnflag, l_linestatus) AS ybar
           FROM lineitem)
SELECT l_returnflag, l_linestatus, count(*) AS n,
       round(avg((p - ybar) * (p - ybar)), 6) AS var,
       round(avg(abs(p - y)), 6) AS mae,
       round(avg((p - y) * (p - y)), 6) AS mse,
       round(CASE WHEN var_pop(y) = 0 THEN NULL
                  ELSE 1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) END, 6) AS r2,
       round(sqrt(avg((p - y) * (p - y))), 6) AS rmse
FROM d GROUP BY l_returnflag, l_linestatus"""

_ONE = """
WITH d AS (SELECT l_quantity / 10.0 AS x, l_extendedprice / 10000.0 AS y FROM lineitem),
s AS (SELECT sum(x * y) AS b, sum(x * x) AS a, count(*) AS n FROM d)"""

ORACLE_SQL["linear_fit"] = _ONE + """
SELECT 'linear' AS trainer, round(b / a, 6) AS coefficient FROM s"""

ORACLE_SQL["ridge_fit"] = _ONE + """
SELECT 'ridge' AS trainer, round(b / (a + n * 0.01), 6) AS coefficient FROM s"""

ORACLE_SQL["lasso_fit"] = _ONE + """
SELECT 'lasso' AS trainer, round(sign(b) * greatest(abs(b) - n * 0.01, 0) / a, 6) AS coefficient
FROM s"""

ORACLE_SQL["linear_predictions"] = _ONE + """
SELECT l_orderkey, l_linenumber, round((l_quantity / 10.0) * (b / a), 6) AS prediction
FROM lineitem, s"""

ORACLE_SQL["naive_bayes_fit"] = f"""
WITH d AS (SELECT {RF} AS label, coalesce(l_quantity, 0.0) AS x0,
                  coalesce(l_discount, 0.0) AS x1, coalesce(l_tax, 0.0) AS x2 FROM lineitem),
c AS (SELECT label, count(*) AS nc, sum(x0) AS s0, sum(x1) AS s1, sum(x2) AS s2
      FROM d GROUP BY label),
t AS (SELECT sum(nc) AS n, count(*) AS k FROM c)
SELECT label, '_prior' AS feature, round(ln(nc + 1.0) - ln(n + 1.0 * k), 6) AS log_prob FROM c, t
UNION ALL SELECT label, 'l_quantity', round(ln(s0 + 1.0) - ln(s0 + s1 + s2 + 3.0), 6) FROM c
UNION ALL SELECT label, 'l_discount', round(ln(s1 + 1.0) - ln(s0 + s1 + s2 + 3.0), 6) FROM c
UNION ALL SELECT label, 'l_tax', round(ln(s2 + 1.0) - ln(s0 + s1 + s2 + 3.0), 6) FROM c"""


# season CSV files read back: every kept column is a typed double; the
# flags go through the returnflag table (linestatus letters are not in it)
_CSV_TYPED = {
    "l_orderkey": "CAST(l_orderkey AS DOUBLE)",
    "l_linenumber": "CAST(l_linenumber AS DOUBLE)",
    "l_quantity": "l_quantity",
    "l_extendedprice": "l_extendedprice",
    "l_discount": "l_discount",
    "l_tax": "l_tax",
    "l_returnflag": RF,
    "l_linestatus": _category("l_linestatus", RETURNFLAG_CATEGORIES),
    "net_price": "l_extendedprice * (1.0 - l_discount)",
}
# rows without a ship date lie in the season of DIRTY_LAST_YEAR
_SEASON_YEAR = f"CAST(coalesce(year(l_shipdate), {DIRTY_LAST_YEAR}) AS INTEGER)"
_SEASON = ("lpad(CAST(({y} % 100) AS VARCHAR), 2, '0') || "
           "lpad(CAST((({y} + 1) % 100) AS VARCHAR), 2, '0')").format(y=_SEASON_YEAR)
_CSV_CONDS = [f"{_SEASON_YEAR} <= {EARLY_LAST_YEAR}",
              f"{_SEASON_YEAR} > {EARLY_LAST_YEAR} AND {_SEASON_YEAR} <= {MIDDLE_LAST_YEAR}",
              f"{_SEASON_YEAR} > {MIDDLE_LAST_YEAR}"]


def _csv_group(cols, cond):
    kept = [c for c in cols if c not in CSV_EXCLUDES]
    sel = ", ".join(f"{_CSV_TYPED[c]} AS {c}" for c in kept)
    return (f"SELECT {sel}, {_SEASON} AS season, {_SEASON_YEAR} AS start_year "
            f"FROM lineitem WHERE {cond}")


_COLLATED = "\nUNION ALL BY NAME\n".join(
    _csv_group(c, k) for c, k in zip([CSV_EARLY, CSV_MIDDLE, CSV_LATE], _CSV_CONDS))

ORACLE_SQL["collate_csv"] = _COLLATED
ORACLE_SQL["collated_season_scan"] = (
    f"SELECT * FROM ({_COLLATED}) WHERE start_year >= 1997 AND start_year < 2000")


ORACLE_SQL["components_sink"] = _TWO + f""",
r AS (SELECT sign(corr(n0, n1)) AS s FROM nx),
lab AS (SELECT l_orderkey, l_linenumber, {RF} AS rf,
               l_quantity, l_quantity + l_discount * 10.0 AS q_plus FROM lineitem),
ln AS (SELECT l_orderkey, l_linenumber, rf, l_quantity AS x0, q_plus AS x1,
              sqrt(l_quantity * l_quantity + q_plus * q_plus) AS nrm FROM lab),
lx AS (SELECT l_orderkey, l_linenumber, rf,
              CASE WHEN nrm = 0 THEN x0 ELSE x0 / nrm END AS n0,
              CASE WHEN nrm = 0 THEN x1 ELSE x1 / nrm END AS n1 FROM ln)
SELECT l_orderkey, l_linenumber, rf,
       round(n0 * sqrt(0.5) + n1 * (s * sqrt(0.5)), 6) AS Comp1,
       round(n0 * sqrt(0.5) + n1 * (-s * sqrt(0.5)), 6) AS Comp2
FROM lx, r"""

# seasons 1997-1999 only: the middle layout (1997-1998) and the first late
# season (1999); no early-layout file is read, so its columns are absent
ORACLE_SQL["season_pruned_csv"] = (
    _csv_group(CSV_MIDDLE, f"{_YEAR} >= 1997 AND {_YEAR} <= {MIDDLE_LAST_YEAR}")
    + "\nUNION ALL BY NAME\n"
    + _csv_group(CSV_LATE, f"{_YEAR} > {MIDDLE_LAST_YEAR} AND {_YEAR} < 2000"))

# Isotonic fit by its max-min form: the fitted value at x is the largest, over
# starts up to x, of the smallest mean of a range from that start to x or beyond.
ORACLE_SQL["isotonic_fit"] = """
WITH g AS (SELECT l_quantity AS x, sum(l_extendedprice / 1000.0) AS s, count(*) AS n
           FROM lineitem GROUP BY 1),
p AS (SELECT x, row_number() OVER (ORDER BY x) AS i, s, n,
             sum(s) OVER (ORDER BY x) AS cs, sum(n) OVER (ORDER BY x) AS cn FROM g),
r AS (SELECT a.i AS i, b.i AS j, (b.cs - a.cs + a.s) / (b.cn - a.cn + a.n) AS m
      FROM p a JOIN p b ON a.i <= b.i),
least_mean AS (SELECT k.i AS k, r.i AS i, min(r.m) AS m
               FROM p k JOIN r ON r.i <= k.i AND r.j >= k.i GROUP BY k.i, r.i),
fit AS (SELECT p.x, max(m) AS fitted FROM least_mean JOIN p ON p.i = least_mean.k GROUP BY p.x)
SELECT l_orderkey, l_linenumber, round(l_extendedprice / 1000.0, 6) AS label,
       round(fitted, 6) AS prediction
FROM lineitem JOIN fit ON fit.x = lineitem.l_quantity"""

ORACLE_SQL["isotonic_blocks"] = ORACLE_SQL["isotonic_fit"].split("SELECT l_orderkey")[0] + """
SELECT round(fitted, 4) AS fitted, min(x) AS lo, max(x) AS hi, CAST(sum(n) AS BIGINT) AS n
FROM fit JOIN p USING (x) GROUP BY 1"""

_ONE_HOT = """
WITH g AS (SELECT l_returnflag AS flag, avg(CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END) AS p,
                  count(*) / sum(count(*)) OVER () AS share
           FROM lineitem GROUP BY l_returnflag)"""
ORACLE_SQL["logistic_one_hot"] = _ONE_HOT + """
SELECT flag, round(ln(p / (1 - p)), 4) AS coefficient FROM g"""
ORACLE_SQL["svm_one_hot"] = _ONE_HOT + """
SELECT flag, round(greatest(-1, least(1, share * (2 * p - 1) / 0.01)), 6) AS coefficient FROM g"""

ORACLE_SQL["multinomial_one_hot"] = """
WITH g AS (SELECT l_linestatus, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CASE l_linestatus WHEN 'F' THEN 1.0 ELSE -1.0 END::DOUBLE AS ls,
       CASE l_returnflag WHEN 'R' THEN 1.0 WHEN 'N' THEN 0.0 ELSE -1.0 END::DOUBLE AS label,
       round(n / sum(n) OVER (PARTITION BY l_linestatus), 4) AS probability
FROM g"""

ORACLE_SQL["collate_dirty_csv"] = """
WITH s AS (SELECT *, least(coalesce(year(l_shipdate), 2001), 2001) AS y, l_linenumber % 4 AS kind
           FROM lineitem)
SELECT l_orderkey::DOUBLE AS l_orderkey, l_linenumber::DOUBLE AS l_linenumber,
       CASE WHEN kind <> 3 THEN l_quantity END AS l_quantity,
       CASE WHEN kind <> 1 THEN CASE l_returnflag WHEN 'R' THEN 1.0 WHEN 'N' THEN 0.0
            WHEN 'A' THEN -1.0 END::DOUBLE END AS l_returnflag,
       CASE WHEN kind <> 1 THEN l_discount END AS l_discount,
       CASE WHEN kind <> 1 AND y > 1996 THEN l_tax END AS l_tax,
       lpad((y % 100)::VARCHAR, 2, '0') || lpad(((y + 1) % 100)::VARCHAR, 2, '0') AS season,
       y::INTEGER AS start_year
FROM s"""

_SMOOTHING = ", ".join(f"({i}, {o.get('lambda_', 1.0)!r}::DOUBLE)"
                       for i, o in enumerate(TRAINER_OVERRIDES["naive_bayes"]))
_X = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_SUM = " + ".join(f"abs({c})" for c in _X)
_SPLIT_LINE = _SPLIT.replace("o_orderkey", "l_orderkey")
ORACLE_SQL["bayes_sweep"] = f"""
WITH m AS (SELECT {_SPLIT_LINE} AS t,
                  CASE l_returnflag WHEN 'R' THEN 1.0 WHEN 'A' THEN -1.0 END::DOUBLE AS rf,
                  CASE l_linestatus WHEN 'F' THEN 1.0 WHEN 'O' THEN -1.0 END::DOUBLE AS ls,
                  {", ".join(f"abs({c}) / ({_SUM}) AS x{i}" for i, c in enumerate(_X))}
           FROM lineitem WHERE l_returnflag IN ('R', 'A') AND l_linestatus IN ('F', 'O') AND {_SUM} > 0),
e AS (SELECT row_number() OVER () AS id, u.* FROM (
      SELECT 'RF' AS label_expr, rf AS y, * FROM m UNION ALL SELECT 'LS', ls, * FROM m UNION ALL
      SELECT 'RF * LS', rf * ls, * FROM m UNION ALL SELECT 'RF - LS', rf - ls, * FROM m) u),
s AS (SELECT label_expr, y AS c, count(*) AS n,
             {", ".join(f"sum(x{i}) AS s{i}" for i in range(4))} FROM e WHERE NOT t GROUP BY 1, 2),
k AS (SELECT label_expr, sum(n) AS total, count(*) AS classes FROM s GROUP BY 1),
lam(param_set, l) AS (VALUES {_SMOOTHING}),
w AS (SELECT s.label_expr, c, param_set, ln(n + l) - ln(total + classes * l) AS pi,
             {", ".join(f"ln(s{i} + l) - ln(s0 + s1 + s2 + s3 + 4 * l) AS w{i}" for i in range(4))}
      FROM s JOIN k USING (label_expr), lam),
p AS (SELECT e.id, e.label_expr, param_set, any_value(y) AS y,
             arg_max(c, pi + x0 * w0 + x1 * w1 + x2 * w2 + x3 * w3) AS p
      FROM e JOIN w USING (label_expr) WHERE t GROUP BY 1, 2, 3),
a AS (SELECT *, avg(y) OVER (PARTITION BY label_expr, param_set) AS ybar FROM p)
SELECT label_expr, param_set, count(*) AS n,
       (SELECT round(avg(CASE WHEN t THEN 1.0 ELSE 0.0 END), 6) FROM m) AS test_ratio,
       round(avg((p - ybar) * (p - ybar)), 6) AS var, round(avg(abs(p - y)), 6) AS mae,
       round(avg((p - y) * (p - y)), 6) AS mse,
       round(1 - sum((p - y) * (p - y)) / sum((y - ybar) * (y - ybar)), 6) AS r2,
       round(sqrt(avg((p - y) * (p - y))), 6) AS rmse
FROM a GROUP BY label_expr, param_set"""


# headers of the written files: one layout a season
_WRITTEN = f"""
WITH inv AS (
  SELECT DISTINCT {_SEASON_YEAR} AS start_year,
         CASE WHEN {_SEASON_YEAR} <= {EARLY_LAST_YEAR} THEN {_list(CSV_EARLY)}
              WHEN {_SEASON_YEAR} <= {MIDDLE_LAST_YEAR} THEN {_list(CSV_MIDDLE)}
              ELSE {_list(CSV_LATE)} END AS header
  FROM lineitem)"""

ORACLE_SQL["csv_title_order"] = _WRITTEN + """,
lg AS (SELECT start_year FROM inv ORDER BY len(header) DESC, start_year LIMIT 1),
ex AS (SELECT CASE WHEN start_year = (SELECT start_year FROM lg) THEN 0 ELSE 1 END AS r0, start_year,
              unnest(header) AS title, unnest(range(len(header))) AS pos FROM inv),
fst AS (SELECT * FROM ex QUALIFY row_number() OVER (PARTITION BY title ORDER BY r0, start_year, pos) = 1)
SELECT title, CAST(row_number() OVER (ORDER BY r0, start_year, pos) AS INTEGER) AS position FROM fst"""

ORACLE_SQL["csv_unknown_columns"] = _WRITTEN + f"""
SELECT title, count(*) AS n_seasons FROM (SELECT start_year, unnest(header) AS title FROM inv)
WHERE title = 'l_tax' OR title NOT IN ({", ".join(f"'{c}'" for c in LINEITEM_CATALOGUE)})
GROUP BY title"""

ORACLE_SQL["csv_label_prefix"] = _WRITTEN + f"""
SELECT start_year, array_to_string(header[1:2], ',') AS actual, header[1:2] = {_list(PREFIX_LABELS[:2])} AS ok FROM inv"""

ORACLE_SQL["null_fill_features"] = "\nUNION ALL\n".join(
    f"SELECT l_orderkey, l_linenumber, CAST({i} AS INTEGER) AS idx, "
    f"round(abs(coalesce({c}, 0.0)), 6) AS value FROM lineitem"
    for i, c in enumerate(["l_quantity", "nullif(l_discount, 0.0)", "-nullif(l_tax, 0.0)"]))

_CRAMER = """
SELECT {keys}trainer, (g11 + p) * (g22 + p) - g12 * g12 AS det, ((g22 + p) * b1 - g12 * b2) AS c1,
       ((g11 + p) * b2 - g12 * b1) AS c2
FROM (SELECT *, n * penalty AS p FROM s, (VALUES ('linear', 0.0), ('ridge', 0.01)) AS t(trainer, penalty))"""
ORACLE_SQL["least_squares_fits"] = f"""
WITH d AS (SELECT l_quantity / 10.0 AS x1, l_discount * 10.0 AS x2, l_extendedprice / 10000.0 AS y FROM lineitem),
s AS (SELECT count(*) AS n, sum(x1 * x1) AS g11, sum(x1 * x2) AS g12, sum(x2 * x2) AS g22,
             sum(x1 * y) AS b1, sum(x2 * y) AS b2 FROM d),
w AS ({_CRAMER.format(keys="")})
SELECT trainer, 'l_quantity' AS feature, round(c1 / det, 5) AS coefficient FROM w
UNION ALL SELECT trainer, 'l_discount', round(c2 / det, 5) FROM w"""

_TWO_SUM = "abs(l_quantity) + abs(l_extendedprice)"
_SHARED_ROWS = f"""
WITH m AS (SELECT {_SPLIT_LINE} AS t,
                  CASE l_returnflag WHEN 'R' THEN 1.0 WHEN 'A' THEN -1.0 END::DOUBLE AS rf,
                  CASE l_linestatus WHEN 'F' THEN 1.0 WHEN 'O' THEN -1.0 END::DOUBLE AS ls,
                  abs(l_quantity) / ({_TWO_SUM}) AS x1, abs(l_extendedprice) / ({_TWO_SUM}) AS x2
           FROM lineitem WHERE l_returnflag IN ('R', 'A') AND l_linestatus IN ('F', 'O') AND {_TWO_SUM} > 0),
e AS (SELECT 'RF' AS label_expr, rf AS y, * FROM m UNION ALL SELECT 'LS', ls, * FROM m UNION ALL
      SELECT 'RF * LS', rf * ls, * FROM m UNION ALL SELECT 'RF - LS', rf - ls, * FROM m)"""
ORACLE_SQL["least_squares_sweep"] = _SHARED_ROWS + f""",
s AS (SELECT label_expr, count(*) AS n, sum(x1 * x1) AS g11, sum(x1 * x2) AS g12, sum(x2 * x2) AS g22,
             sum(x1 * y) AS b1, sum(x2 * y) AS b2 FROM e WHERE NOT t GROUP BY label_expr),
w AS ({_CRAMER.format(keys="label_expr, ")}),
p AS (SELECT label_expr, trainer, y, (x1 * c1 + x2 * c2) / det AS p FROM e JOIN w USING (label_expr) WHERE t),
a AS (SELECT *, avg(y) OVER (PARTITION BY label_expr, trainer) AS ybar FROM p)
SELECT trainer, label_expr, count(*) AS n,
       (SELECT round(avg(CASE WHEN t THEN 1.0 ELSE 0.0 END), 6) FROM m) AS test_ratio,
       round(avg((p - ybar) * (p - ybar)), 5) AS var, round(avg(abs(p - y)), 5) AS mae,
       round(avg((p - y) * (p - y)), 5) AS mse,
       round(1 - sum((p - y) * (p - y)) / sum((y - ybar) * (y - ybar)), 5) AS r2,
       round(sqrt(avg((p - y) * (p - y))), 5) AS rmse
FROM a GROUP BY label_expr, trainer"""

# A proof has one right answer: the gap is closed for every fit.
ORACLE_SQL["optimal_fits"] = f"""
SELECT trainer, label_expr, penalty,
       (SELECT count(*) FROM lineitem WHERE l_returnflag IN ('R', 'A') AND l_linestatus IN ('F', 'O')
          AND {_SUM} > 0 AND NOT {_SPLIT_LINE}) AS n, true AS proven
FROM (VALUES ('logistic'), ('svm')) AS a(trainer),
     (VALUES ('RF'), ('LS'), ('RF * LS'), ('RF - LS')) AS b(label_expr),
     (VALUES (0.01::DOUBLE), (0.005::DOUBLE)) AS c(penalty)"""


ORACLE_SQL["repair_report"] = """
WITH s AS (SELECT *, CAST(least(coalesce(year(l_shipdate), 2001), 2001) AS INTEGER) AS y, l_linenumber % 4 AS kind FROM lineitem)
SELECT y AS start_year, count(*) AS n_rows, CAST(count_if(kind = 1) AS BIGINT) AS n_short, CAST(count_if(kind = 2) AS BIGINT) AS n_long,
       CAST(count_if((kind = 3 OR l_quantity IS NULL) AND (kind = 1 OR l_returnflag IS NULL OR l_returnflag NOT IN ('R', 'N', 'A'))
            AND (kind = 1 OR l_discount IS NULL) AND (kind = 1 OR y <= 1996 OR l_tax IS NULL)) AS BIGINT) AS n_blank
FROM s GROUP BY y"""

ORACLE_SQL["drop_report"] = """
SELECT count(*) AS n_rows, CAST(count_if(coalesce(l_discount, 0) = 0) AS BIGINT) AS n_unlabelled,
       CAST(count_if(coalesce(l_discount, 0) <> 0 AND coalesce(l_tax, 0) = 0) AS BIGINT) AS n_featureless,
       CAST(count_if(coalesce(l_discount, 0) <> 0 AND coalesce(l_tax, 0) <> 0) AS BIGINT) AS n_kept
FROM lineitem"""

ORACLE_SQL["components_range"] = _TWO + """,
r AS (SELECT sign(corr(n0, n1)) AS s FROM nx)
SELECT l_orderkey, l_linenumber, round(n0 * sqrt(0.5) + n1 * (s * sqrt(0.5)), 6) AS Comp1 FROM nx, r"""
