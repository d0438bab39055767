"""Writing season tables, predictions and exports. Every writer is one distributed job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlens.functions.exprs import plain_text


def _seasons(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of a season come together, so that not every task adds a small file to every season;
    adaptive execution cuts a long season into files of its advisory partition size."""
    together = df.hint("rebalance", F.col("season"))
    return together.sortWithinPartitions("season", *order) if order else together


def write_seasons(df: DataFrame, path: str, mode: str = "overwrite", order: Sequence[str] = ()) -> None:
    """Parquet partitioned by season; ``overwrite`` replaces the whole table.

    With ``order`` (say, the week) rows are sorted within their file, so that a reader of one week skips row groups.
    """
    _seasons(df, order).write.mode(mode).partitionBy("season").parquet(path)


def replace_seasons(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Replace the seasons that ``df`` has rows of and leave all others as they are; new seasons are added.

    Files are written aside and moved when the job commits, so a run that fails changes nothing and a rerun gives the
    same table. ``df`` must not read from ``path``. No rows replace nothing.
    """
    writer = _seasons(df, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("season").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header and no index column."""
    df.write.mode(mode).csv(path, header=True)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV of a view's rows; commas in values become dashes."""
    write_csv(plain_text(df), path, mode)
