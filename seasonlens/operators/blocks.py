"""Splitting hot groups of an ordered window into time-contiguous blocks.

A window puts all rows of a group into one task. When one entity holds a large share of the
table that task never ends. Here the rows of hot groups are partitioned by ranges of (group,
order) and sorted, and each partition is cut into blocks of consecutive rows, so that a block
holds a stretch of one or several groups. Windows then run per (group, block), a small table of
block totals is scanned per group, and what the earlier blocks add up to is joined back.

Range bounds come from Spark's own sample and decide only where blocks end. Totals are exact
(``operators/exact.py``), so results do not depend on that.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlens.session import stage

#: rows of a group beyond which it is computed in blocks: a choice of plan, not of result
ROWS_PER_BLOCK = 2_000_000
#: partitions that hot rows are dealt to, at most. Spark's sample of range bounds is gathered on the driver and every
#: task of one shuffle writes to each of them, so their number must not grow with the rows; blocks may.
MAX_PARTITIONS = 256

BLOCK = "__block"
LANE = "__lane"


def all_known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def lane(df: DataFrame, keys: list[str]) -> Column:
    """0 for rows with a complete key; spreads the others, which belong to no group."""
    return F.when(all_known(keys), F.lit(0).cast("long")).otherwise(F.xxhash64(*df.columns))


def hot_keys(df: DataFrame, keys: list[str], rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame | None:
    """Keys and ``__rows`` of the groups above ``rows_per_block``, staged; None if there is none.

    Reads the key columns only and counts before the shuffle. There are at most
    rows / rows_per_block such groups; none of them reach the driver.
    """
    sizes = (
        df.where(all_known(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > rows_per_block)
    )
    found = stage(sizes, "hot-keys")
    return None if found.isEmpty() else found


def split(
    df: DataFrame, keys: list[str], order: list[str], hot: DataFrame, rows_per_block: int = ROWS_PER_BLOCK
) -> tuple[DataFrame, DataFrame]:
    """The rows of all other groups, those without a complete key included, and of the hot ones with ``BLOCK``.

    Blocks of a group are numbered in its order, and rows that tie on ``order`` may be in two of them. The hot rows
    are written once with their block before they are read several times, as a second evaluation could cut elsewhere.
    """
    n = math.ceil(hot.agg(F.sum("__rows")).first()[0] / rows_per_block)
    named = hot.select(*keys)
    rows = df.join(named, keys, "left_semi").repartitionByRange(max(1, min(n, MAX_PARTITIONS)), *keys, *order)
    if n > MAX_PARTITIONS:
        rows = rows.sortWithinPartitions(*keys, *order)
    return df.join(named, keys, "left_anti"), stage(rows.withColumn(BLOCK, block_number(n, rows_per_block)), "blocks")


def block_number(n: int, rows_per_block: int) -> Column:
    """The partition if every block has its own, else the partition and the row's stretch of it, which is sorted."""
    partition = F.spark_partition_id().cast("long")
    if n <= MAX_PARTITIONS:
        return partition
    # the id's lower 33 bits count the rows of a partition
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return F.shiftleft(partition, 33) + F.floor(place / rows_per_block).cast("long")
