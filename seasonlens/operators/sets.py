"""Unions, distinct values and selections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def home_and_away(df: DataFrame, keys: list[str], home: dict[str, str], away: dict[str, str]) -> DataFrame:
    """Two rows per game, one per side, in a single scan.

    ``home`` and ``away`` map each output column to the column it has on that side.
    """
    side = F.explode(
        F.array(*[F.struct(*[F.col(source).alias(out) for out, source in view.items()]) for view in (home, away)])
    )
    return df.select(*keys, side.alias("__side")).select(*keys, "__side.*")


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Stack tables of different columns; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns, nulls being equal."""
    return df.dropDuplicates()


def once(df: DataFrame, keys: list[str], prefer: Column | None = None) -> DataFrame:
    """One row per key; with ``prefer``, the row where it is smallest, whatever the partitioning."""
    if prefer is None:
        return df.dropDuplicates(keys)
    rest = [name for name in df.columns if name not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), prefer).alias("__best"))
    return best.select(*keys, "__best.*").select(*df.columns)


def choices(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Sorted distinct values."""
    return df.select(column).distinct().orderBy(F.desc(column) if descending else F.asc(column))


def first_seen(df: DataFrame, column: str, order: Column) -> DataFrame:
    """Distinct values with the position at which each first occurs, in that order."""
    return df.groupBy(column).agg(F.min(order).alias("first_seen")).orderBy("first_seen")


def add_to_selection(selected: DataFrame, added: DataFrame) -> DataFrame:
    """Both tables' rows, each once."""
    return selected.unionByName(added).distinct()


def remove_from_selection(selected: DataFrame, removed: DataFrame) -> DataFrame:
    """Rows of ``selected`` that are not in ``removed``."""
    return selected.join(removed.distinct(), selected.columns, "left_anti")
