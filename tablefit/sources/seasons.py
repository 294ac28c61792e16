"""Seasons (S1): codes, ranges and the paths to read.

A season starting in 2000 is coded ``0001``; codes do not sort across the
century (``9394`` > ``0001``), so every table carries the integer
``start_year`` and season filters use it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_TEMPLATE = "{root}/{code}"


@dataclass(frozen=True)
class Season:
    start_year: int
    code: str
    path: str


def season_code(start_year: int) -> str:
    """Two-digit start year + two-digit end year: 2000 -> '0001'."""
    return f"{start_year % 100:02d}{(start_year + 1) % 100:02d}"


def check_range(start_year, end_year, min_year: int | None = None,
                max_year: int | None = None) -> None:
    """Half-open range [start, end) of start years; end may equal the last
    allowed year (the last season then ends in it). No limit applies unless
    one is given."""
    for v in (start_year, end_year):
        if isinstance(v, bool) or not isinstance(v, int):
            raise TypeError(f"season years must be integers, got {v!r}")
    if not start_year < end_year:
        raise ValueError(f"empty season range [{start_year}, {end_year})")
    if (min_year is not None and start_year < min_year) or (
            max_year is not None and end_year > max_year):
        raise ValueError(
            f"season range [{start_year}, {end_year}) is outside [{min_year}, {max_year}]")


def seasons(root: str, start_year: int, end_year: int, template: str = DEFAULT_TEMPLATE,
            min_year: int | None = None, max_year: int | None = None) -> list[Season]:
    """Every season in [start_year, end_year) with its directory."""
    check_range(start_year, end_year, min_year, max_year)
    if end_year - start_year > 100:
        raise ValueError(f"seasons a century apart share a code: [{start_year}, {end_year})")
    root = root.rstrip("/")
    return [Season(y, season_code(y), template.format(root=root, code=season_code(y), year=y))
            for y in range(start_year, end_year)]


def season_range_condition(start_year: int, end_year: int, col: str = "start_year") -> Column:
    return (F.col(col) >= F.lit(start_year)) & (F.col(col) < F.lit(end_year))


def filter_seasons(df: DataFrame, start_year: int, end_year: int,
                   col: str = "start_year") -> DataFrame:
    """S1 on a stored table: a range filter on the integer partition column,
    which Spark turns into partition pruning (only the matching
    ``start_year=...`` directories are listed and read)."""
    check_range(start_year, end_year)
    return df.where(season_range_condition(start_year, end_year, col))
