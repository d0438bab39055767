"""Running totals and ranks that keep nulls in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlens.operators.blocks import BLOCK, LANE, ROWS_PER_BLOCK, all_known, hot_keys, lane, split
from seasonlens.operators.exact import Measures, is_whole


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, out: str,
                  rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Sum of ``value`` up to and including each row of its group; a null value stays null.

    Rows that tie on ``order`` follow each other in any order, so give a total order. Groups are
    counted when this is called, on the key columns. The total is exact, whole or in blocks.
    """
    keep = [*df.columns, out]
    hot = hot_keys(df, keys, rows_per_block)
    if hot is None:
        return _total_whole(df, keys, order, value, out).select(*keep)
    cold, blocks = split(df, keys, order, hot, rows_per_block)
    whole = _total_whole(cold, keys, order, value, out).select(*keep)
    return whole.unionByName(_total_blocked(blocks, keys, order, value, out).select(*keep))


def _total(measures: Measures, df: DataFrame, value: str, of) -> Column:
    """A long for whole numbers, else a double."""
    return of(measures.of[0][0]) if is_whole(df, value) else measures.total(0, of)


def _total_whole(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    to_date = Window.partitionBy(*keys, LANE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    measures = Measures(df, [value])
    rows = df.withColumns({LANE: lane(df, keys), **measures.columns})
    total = _total(measures, df, value, lambda name: F.sum(name).over(to_date))
    return rows.withColumn(out, F.when(all_known(keys) & F.col(value).isNotNull(), total))


def _total_blocked(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    part = [*keys, BLOCK]
    to_date = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    measures = Measures(df, [value])
    raw = df.withColumns(measures.columns)
    rows = raw.withColumns({f"__local{name}": F.sum(name).over(to_date) for name in measures.names})
    # summed before the shuffle; one row per block from here on
    carried = (
        raw.groupBy(*part)
        .agg(*[F.sum(name).alias(name) for name in measures.names])
        .select(*part, *[F.sum(name).over(before).alias(f"__prior{name}") for name in measures.names])
    )
    zero = F.lit(0).cast("long")
    total = _total(measures, df, value, lambda name: F.col(f"__local{name}") + F.coalesce(f"__prior{name}", zero))
    return rows.join(carried, part, "left").withColumn(out, F.when(F.col(value).isNotNull(), total))


def rank_min(df: DataFrame, keys: list[str], value: str, out: str,
             rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Competition rank of ``value`` in its group, ascending; ties share the lowest, null stays null."""
    ranked = F.col(value).isNotNull()
    if hot_keys(df.where(ranked), keys, rows_per_block) is not None:
        return _rank_counted(df, keys, value, out, rows_per_block)
    # unranked rows need no group: spread them instead of sorting them in
    unranked = F.when(all_known(keys) & ranked, F.lit(0).cast("long")).otherwise(F.xxhash64(*df.columns))
    in_group = Window.partitionBy(*keys, LANE).orderBy(F.asc_nulls_last(value))
    rows = df.withColumn(LANE, unranked)
    rank = F.when(all_known(keys) & ranked, F.rank().over(in_group).cast("long"))
    return rows.withColumn(out, rank).select(*df.columns, out)


def _rank_counted(df: DataFrame, keys: list[str], value: str, out: str, rows_per_block: int) -> DataFrame:
    """Count equal values first, so that ties of any number cost one row; rank is 1 + rows below."""
    counts = (
        df.where(all_known(keys) & F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("__ties"))
    )
    below = running_total(counts, keys, [value], "__ties", "__up_to", rows_per_block).select(
        *keys, value, (F.col("__up_to") - F.col("__ties") + 1).cast("long").alias(out)
    )
    return df.join(below, [*keys, value], "left").select(*df.columns, out)
