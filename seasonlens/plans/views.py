"""The queries behind the views on a prediction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonlens.functions.exprs import contains_text, fill_nulls, position_filter, round_numbers, splice, week_label
from seasonlens.operators.sets import choices, first_seen, once

ACTUAL, PREDICTED = "fantasy_points_ppr", "predicted_fantasy"

# Statistics a snapshot shows, position codes and top-k sizes to choose from.
SHOWN_STATS = ["passing_yards", "passing_tds", "rushing_yards", "rushing_tds", "receptions", "interceptions"]
POSITIONS = ["All", "FLEX", "QB", "RB", "WR", "TE", "K"]
TOP_SIZES = [8, 16, 24, 32]


def top_rows(df: DataFrame, measure: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``measure``, nulls last. Each task keeps k rows; nothing is sorted whole."""
    return df.orderBy(F.desc_nulls_last(measure), *tie_break).limit(int(k))


def leader_board(df: DataFrame, season: int | str, week: int | str, position: str = "All", k: int | str = 32,
                 order_by: str = "Predicted", tie_break: Sequence[str] = ("player_name",)) -> DataFrame:
    """Best players of a week by the predicted or the actual points."""
    measure = {"Predicted": PREDICTED, "Actual": ACTUAL}.get(order_by)
    if measure is None:
        raise ValueError(f"order_by must be 'Predicted' or 'Actual', not {order_by!r}")
    rows = df.where((F.col("season") == int(season)) & (F.col("week") == int(week)) & position_filter(position))
    names = list(dict.fromkeys(["player_name", *tie_break]))
    return top_rows(rows.select(*names, measure), measure, int(k), tie_break)


def leader_boards(df: DataFrame, k: int | str = 32, order_by: str = "Predicted", by: Sequence[str] = ("season", "week", "position"),
                  tie_break: Sequence[str] = ("player_name",)) -> DataFrame:
    """The board of every group at once: its ``k`` best players with their place; nulls are last, ties go by ``tie_break``.

    Each task keeps ``k`` rows of a group before the shuffle, so a group is never gathered whole.
    """
    measure = {"Predicted": PREDICTED, "Actual": ACTUAL}.get(order_by)
    if measure is None:
        raise ValueError(f"order_by must be 'Predicted' or 'Actual', not {order_by!r}")
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc_nulls_last(measure), *tie_break))
    names = list(dict.fromkeys([*by, "player_name", *tie_break, measure]))
    return df.select(*names).withColumn("place", place).where(F.col("place") <= int(k))


def compare_players(df: DataFrame, season: int | str, week: int | str, players: Sequence[str]) -> DataFrame:
    """Per player a spliced series over all weeks and an actual series before ``week``."""
    week = int(week)
    rows = df.where((F.col("season") == int(season)) & F.col("player_name").isin(list(players)))
    spliced = splice(F.col("week"), week, F.col(ACTUAL), F.col(PREDICTED))
    series = F.when(
        F.col("week") < week,
        F.array(F.struct(F.lit("predicted").alias("trace"), spliced.alias("points")),
                F.struct(F.lit("actual").alias("trace"), F.col(ACTUAL).alias("points"))),
    ).otherwise(F.array(F.struct(F.lit("predicted").alias("trace"), spliced.alias("points"))))
    rows = rows.select(F.col("player_name").alias("player"), "week", F.explode(series).alias("point"))
    return rows.select("player", "point.trace", "week", "point.points").orderBy("player", "trace", "week")


def snapshot(df: DataFrame, season: int = 2024, shown: Sequence[str] = SHOWN_STATS) -> DataFrame:
    """One season's rows, gaps in the shown statistics filled, measures rounded, weeks labelled."""
    rows = fill_nulls(df.where(F.col("season") == season), list(shown))
    rows = rows.withColumn("weeks", week_label()).withColumn(PREDICTED, F.col(PREDICTED).cast("double"))
    return round_numbers(rows, 1, [PREDICTED, ACTUAL])


def selected_rows(rows: DataFrame, week: str = "All", players: Sequence[str] = (),
                  row_id: Sequence[str] | None = None) -> DataFrame:
    """Snapshot rows of a week label (or all) and of the chosen players (or all), each row once."""
    if week != "All":
        rows = rows.where(F.col("weeks") == week)
    if players:
        rows = rows.where(F.col("player_name").isin(list(players)))
    return once(rows, list(row_id)) if row_id else rows


def players_in_order(rows: DataFrame, tie_break: Sequence[str]) -> DataFrame:
    """Distinct players by where each first occurs when rows are sorted by descending prediction."""
    order = F.struct(F.coalesce(-F.col(PREDICTED), F.lit(float("inf"))).alias("rank_by"), *tie_break)
    return first_seen(rows, "player_name", order).select("player_name")


def seasons(df: DataFrame, order) -> DataFrame:
    return first_seen(df, "season", order).select("season")


def weeks(df: DataFrame) -> DataFrame:
    return choices(df, "week")


def players(df: DataFrame, search: str = "") -> DataFrame:
    """Sorted player names, optionally those that contain a text in any case."""
    return choices(df.where(contains_text("player_name", search)) if search else df, "player_name")
