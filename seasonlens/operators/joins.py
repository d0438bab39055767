"""Equi-joins with the null and naming rules of the feature pipelines.

No side is forced to broadcast: Spark checks sizes at planning and again at run time, and
splits skewed sort-merge partitions. Sides are aggregated or deduplicated before they get here.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlens.operators.blocks import ROWS_PER_BLOCK


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join where a null key equals a null key; the key columns of ``left`` are kept."""
    renamed = right.withColumnsRenamed({key: f"__right_{key}" for key in on})
    match = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"__right_{key}")) for key in on]
    )
    return left.join(renamed, match, how).drop(*[f"__right_{key}" for key in on])


#: rows that a task of ``spread_join`` makes, about, and its tasks at most: choices of plan, not of result
PAIRS_PER_TASK = 20_000_000
MAX_TASKS = 10_000


def spread_join(left: DataFrame, right: DataFrame, on: list[str], pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """``null_safe_join`` (inner) of short tables whose keys repeat so often that the result is long.

    Spark sizes tasks by what they read. The pairs are counted when this is called, on the key columns, and the rows
    of ``left`` are dealt to enough tasks. That holds where Spark broadcasts ``right``; it splits skewed sides itself.
    """
    sizes = [df.groupBy(*on).agg(F.count(F.lit(1)).alias(name)) for df, name in ((left, "__left"), (right, "__right"))]
    pairs = null_safe_join(*sizes, on).agg(F.sum(F.col("__left").cast("double") * F.col("__right"))).first()[0] or 0
    tasks = min(MAX_TASKS, math.ceil(pairs / pairs_per_task))
    return null_safe_join(left.repartition(tasks) if tasks > 1 else left, right, on)


def has_hot_key(df: DataFrame, keys: list[str], rows: int = ROWS_PER_BLOCK) -> bool:
    """Whether any key, nulls included, has more than ``rows`` rows."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return not sizes.where(F.col("__rows") > rows).limit(1).isEmpty()


def left_join(left: DataFrame, right: DataFrame, on: list[str], screen: list[str] | None = None,
              rows: int = ROWS_PER_BLOCK) -> DataFrame:
    """Null-safe left join where a key may repeat any number of times on the right.

    Spark splits a skewed partition of a left join on its left side only. So if a key is hot on the
    right, matches come from an inner join, which splits on both sides, and the rest of ``left``
    from an anti join with the distinct keys. ``screen`` is a part of the keys with few values: keys
    can only be hot if it is, and counting it needs hardly any shuffle.
    """
    keys = right.select(*on)
    hot = (screen is None or has_hot_key(keys, screen, rows)) and has_hot_key(keys, on, rows)
    if not hot:
        return null_safe_join(left, right, on, "left")
    matched = null_safe_join(left, right, on, "inner")
    unmatched = null_safe_join(left, keys.distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def previous_period(df: DataFrame, on: list[str], period: str, value: str, out: str,
                    rows: int = ROWS_PER_BLOCK, source: DataFrame | None = None) -> DataFrame:
    """Left lookup of ``value`` one calendar period earlier, under the same other keys.

    Unlike a lag, a gap gives null. Several earlier rows under one key repeat the row. Group sizes
    are screened by the first of ``on``. Values come from ``source`` if ``df`` is only a part of it.
    """
    earlier = (df if source is None else source).select(*on, (F.col(period) + 1).alias(period), F.col(value).alias(out))
    return left_join(df, earlier, [period, *on], screen=on[:1], rows=rows)


def suffix_join(left: DataFrame, right: DataFrame, on: list[str], suffixes: tuple[str, str],
                how: str = "left") -> DataFrame:
    """Join on ``on``; other columns that both sides have get the side's suffix."""
    shared = [name for name in left.columns if name in right.columns and name not in on]
    return null_safe_join(
        left.withColumnsRenamed({name: name + suffixes[0] for name in shared}),
        right.withColumnsRenamed({name: name + suffixes[1] for name in shared}),
        on,
        how,
    )


def replace_names(df: DataFrame, roster: DataFrame, key: str = "player_id", name: str = "player_name") -> DataFrame:
    """Take ``name`` from the roster (inner join).

    The roster repeats a player per season, so it is made distinct first. An entity spelled two
    ways appears twice.
    """
    return null_safe_join(df.drop(name), roster.select(key, name).distinct(), [key], "inner")
