"""Exclusion projection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from tablefit.functions.fixed import (ASIAN_HANDICAP, AVERAGES_MAXIMUMS, BASE_EXCLUDES,
                                      OVER_UNDER_2_5)


def exclusion_list(exc_handicap: bool = True, exc_averages: bool = True,
                   exc_2_5_goals: bool = True, base: Sequence[str] = BASE_EXCLUDES,
                   extra: Iterable[str] = ()) -> list[str]:
    """Base exclusions plus the optional families, in a stable order."""
    names = list(base)
    if exc_handicap:
        names += ASIAN_HANDICAP
    if exc_averages:
        names += AVERAGES_MAXIMUMS
    if exc_2_5_goals:
        names += OVER_UNDER_2_5
    names += list(extra)
    seen, out = set(), []
    for n in names:
        if n not in seen:
            seen.add(n)
            out.append(n)
    return out


def kept_titles(header: Sequence[str], excludes: Iterable[str]) -> list[str]:
    """Titles of ``header`` that survive the exclusion list, in order."""
    drop = set(excludes)
    return [t for t in header if t not in drop]


def exclude_columns(df: DataFrame, excludes: Iterable[str]) -> DataFrame:
    """Drop the named columns; names the frame does not have are ignored.
    A pure projection: Catalyst prunes the dropped columns from the scan."""
    return df.drop(*list(excludes))
