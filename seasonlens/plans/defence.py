"""Points a defence has allowed, its rank, and the points it gave up to each position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlens.functions.feature_lists import TARGET
from seasonlens.operators.blocks import ROWS_PER_BLOCK
from seasonlens.operators.joins import left_join
from seasonlens.operators.running import rank_min, running_total
from seasonlens.operators.sets import home_and_away
from seasonlens.session import stage


def points_allowed(schedules: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """One row per team and game: points allowed so far in the season and the week's rank by them."""
    sides = home_and_away(
        schedules,
        ["game_id", "season", "week"],
        home={"team": "home_team", "points_allowed": "away_score"},
        away={"team": "away_team", "points_allowed": "home_score"},
    ).withColumn("adj_week", F.col("week") + 1)
    # each is read for the sizes of its groups and then again
    sides = stage(sides, "sides")
    totals = running_total(sides, ["season", "team"], ["week", "game_id", "points_allowed"], "points_allowed",
                           "cumulative_points_allowed", rows_per_block)
    ranked = rank_min(stage(totals, "points-allowed"), ["season", "week"], "cumulative_points_allowed",
                      "defensive_rank", rows_per_block)
    return ranked.withColumnRenamed("team", "opponent_team")


def points_given_up(allowed: DataFrame, players: DataFrame) -> DataFrame:
    """Each defence week with every opposing player's points; weeks without one keep a null.

    ``players`` is the result of a join that repeats rows, so the five columns needed are counted, staged and only
    repeated again after the last shuffle.
    """
    given = players.groupBy("week", "season", "opponent_team", "position", TARGET).agg(F.count(F.lit(1)).alias("__copies"))
    given = stage(given, "given-up")
    rows = left_join(allowed, given, ["week", "season", "opponent_team"])
    rows = rows.withColumn("__copies", F.explode(F.sequence(F.lit(1), F.coalesce("__copies", F.lit(1)))))
    return rows.drop("__copies").withColumnsRenamed({"week": "week_of_interest", TARGET: "prior_allowed_fp"}).withColumnRenamed(
        "adj_week", "week"
    )
