"""Label expressions (P4) and label encodings for classifiers (Q7)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_SQL_WORDS = {"and", "or", "not", "case", "when", "then", "else", "end", "null",
              "true", "false", "abs", "sign", "signum", "cast", "as", "double", "int",
              "pow", "power", "sqrt", "least", "greatest", "coalesce", "if", "e"}


def referenced_names(expression: str) -> list[str]:
    """Identifiers used by a label expression (function names and SQL words
    excluded)."""
    names = []
    for m in _NAME.finditer(expression):
        word = m.group(0)
        rest = expression[m.end():].lstrip()
        if rest.startswith("("):
            continue
        # a number such as 1e5 is matched from its exponent letter; skip it
        if m.start() > 0 and (expression[m.start() - 1].isdigit() or expression[m.start() - 1] == "."):
            continue
        if word.lower() in _SQL_WORDS:
            continue
        names.append(word)
    return names


def quoted(expression: str, columns: Iterable[str]) -> str:
    """The expression with back quotes around every blank-separated token
    that is the title of a column but no plain name (``BbMx>2.5``)."""
    known = {c for c in columns if not _NAME.fullmatch(c)}
    return "".join(f"`{t}`" if t in known else t for t in re.split(r"(\s+)", expression))


def check_label_expression(expression: str, columns: Iterable[str]) -> None:
    known = set(columns)
    text = quoted(expression, known)
    names = re.findall(r"`([^`]*)`", text) + referenced_names(re.sub(r"`[^`]*`", " ", text))
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(
            f"label expression {expression!r} uses unknown column(s) {unknown}; "
            f"available: {sorted(known)}")


def label_column(expression: str, columns: Iterable[str] | None = None) -> Column:
    """A label as a double column from an expression such as
    ``"FTAG - FTHG"``. Column names are checked first so an unknown name
    gives a clear error rather than an analysis exception."""
    if columns is not None:
        columns = list(columns)
        check_label_expression(expression, columns)
        expression = quoted(expression, columns)
    return F.expr(expression).cast("double")


def binary_label(label: str | Column) -> Column:
    """Two-class encoding for logistic regression / SVM: 1.0 if the label is
    positive, else 0.0."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c > 0, F.lit(1.0)).otherwise(F.lit(0.0))
