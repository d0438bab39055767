"""Leader boards, comparisons, snapshots and selections over the prediction table."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonlens.operators.metrics import bounds
from seasonlens.plans.views import (
    compare_players,
    leader_board,
    leader_boards,
    players,
    players_in_order,
    selected_rows,
    snapshot,
    top_rows,
    weeks,
)
from seasonlens.plans.views import seasons as seasons_in_order
from seasonlens.queries.registry import query
from seasonlens.queries.roles import GAMES, PREDICTIONS, predictions, with_sql

TIE = ("player_name", "game_id")


def board_sql(where: str, measure: str, k: int) -> str:
    return with_sql(
        GAMES, PREDICTIONS,
        f"""SELECT player_name, game_id, {measure} FROM predictions WHERE season = 1997 AND week = 10 AND {where}
            ORDER BY {measure} DESC NULLS LAST, player_name, game_id LIMIT {k}""",
    )


@query("q1_leaderboard_all", board_sql("true", "predicted_fantasy", 32))
def q1_leaderboard_all(spark, sf_dir):
    return leader_board(predictions(spark, sf_dir), "1997", "10", "All", "32", "Predicted", TIE)


@query("q1_leaderboard_flex", board_sql("position IN ('RB','WR','TE','FB')", "fantasy_points_ppr", 16))
def q1_leaderboard_flex(spark, sf_dir):
    return leader_board(predictions(spark, sf_dir), 1997, 10, "FLEX", 16, "Actual", TIE)


@query("q1_leaderboard_code", board_sql("position = 'QB'", "predicted_fantasy", 8))
def q1_leaderboard_code(spark, sf_dir):
    return leader_board(predictions(spark, sf_dir), 1997, 10, "QB", 8, "Predicted", TIE)


@query(
    "q1_leaderboards",
    with_sql(
        GAMES, PREDICTIONS,
        f"""SELECT season, week, position, player_name, {', '.join(t for t in TIE if t != 'player_name')}, predicted_fantasy,
                   CAST(row_number() OVER (PARTITION BY season, week, position
                                           ORDER BY predicted_fantasy DESC NULLS LAST, {', '.join(TIE)}) AS INT) AS place
            FROM predictions QUALIFY place <= 8""",
    ),
)
def q1_leaderboards(spark, sf_dir):
    """The boards of all seasons, weeks and positions."""
    return leader_boards(predictions(spark, sf_dir), 8, "Predicted", tie_break=TIE)


COMPARED = ["Customer#000000007", "Customer#000000010", "Customer#000000013", "Customer#000000056"]
COMPARED_SQL = ", ".join(f"'{name}'" for name in COMPARED)


@query(
    "q2_compare",
    with_sql(
        GAMES, PREDICTIONS,
        f"chosen AS (SELECT * FROM predictions WHERE season = 1997 AND player_name IN ({COMPARED_SQL}))",
        """SELECT player_name AS player, 'predicted' AS trace, week,
                  CASE WHEN week < 7 THEN fantasy_points_ppr ELSE predicted_fantasy END AS points FROM chosen
           UNION ALL SELECT player_name, 'actual', week, fantasy_points_ppr FROM chosen WHERE week < 7""",
    ),
)
def q2_compare(spark, sf_dir):
    return compare_players(predictions(spark, sf_dir), "1997", "7", COMPARED)


SHOWN = ["rushing_yards", "receptions"]
SNAPSHOT = """snapshot AS (
  SELECT * REPLACE (coalesce(rushing_yards, 0) AS rushing_yards, coalesce(receptions, 0) AS receptions,
                    round_even(predicted_fantasy * 10, 0) / 10 AS predicted_fantasy,
                    round_even(fantasy_points_ppr * 10, 0) / 10 AS fantasy_points_ppr),
         'Week ' || CAST(week AS VARCHAR) AS weeks
  FROM predictions WHERE season = 1998)"""
BY_PREDICTION = "ORDER BY predicted_fantasy DESC NULLS LAST, player_name, game_id"


@query("q3_snapshot", with_sql(GAMES, PREDICTIONS, SNAPSHOT, "SELECT * FROM snapshot"))
def q3_snapshot(spark, sf_dir):
    return snapshot(predictions(spark, sf_dir), 1998, SHOWN)


@query("q3_snapshot_top", with_sql(GAMES, PREDICTIONS, SNAPSHOT, f"SELECT * FROM snapshot {BY_PREDICTION} LIMIT 32"))
def q3_snapshot_top(spark, sf_dir):
    return top_rows(snapshot(predictions(spark, sf_dir), 1998, SHOWN), "predicted_fantasy", 32, TIE)


@query(
    "q4_selection",
    with_sql(GAMES, PREDICTIONS, SNAPSHOT,
             f"SELECT * FROM snapshot WHERE weeks = 'Week 5' {BY_PREDICTION} LIMIT 32"),
)
def q4_selection(spark, sf_dir):
    rows = selected_rows(snapshot(predictions(spark, sf_dir), 1998, SHOWN), "Week 5", row_id=["game_id"])
    return top_rows(rows, "predicted_fantasy", 32, TIE)


@query(
    "q4_selection_players",
    with_sql(GAMES, PREDICTIONS, SNAPSHOT, f"SELECT * FROM snapshot WHERE player_name IN ({COMPARED_SQL})"),
)
def q4_selection_players(spark, sf_dir):
    return selected_rows(snapshot(predictions(spark, sf_dir), 1998, SHOWN), "All", COMPARED, ["game_id"])


@query(
    "q4_bounds",
    with_sql(GAMES, PREDICTIONS, SNAPSHOT,
             """SELECT least(0.0::DOUBLE, min(predicted_fantasy), min(fantasy_points_ppr)) AS lower_bound
                FROM snapshot WHERE weeks = 'Week 5'"""),
)
def q4_bounds(spark, sf_dir):
    rows = selected_rows(snapshot(predictions(spark, sf_dir), 1998, SHOWN), "Week 5")
    return bounds(rows, ["predicted_fantasy", "fantasy_points_ppr"])


@query(
    "q4_players",
    with_sql(GAMES, PREDICTIONS, SNAPSHOT,
             "SELECT DISTINCT player_name FROM snapshot WHERE weeks = 'Week 5'"),
)
def q4_players(spark, sf_dir):
    rows = selected_rows(snapshot(predictions(spark, sf_dir), 1998, SHOWN), "Week 5")
    return players_in_order(rows, TIE)


@query(
    "q5_choices",
    with_sql(
        GAMES, PREDICTIONS,
        """SELECT DISTINCT 'season' AS kind, CAST(season AS VARCHAR) AS choice FROM predictions
           UNION ALL SELECT DISTINCT 'week', CAST(week AS VARCHAR) FROM predictions
           UNION ALL SELECT DISTINCT 'player', player_name FROM predictions WHERE contains(lower(player_name), 'r#0000001')
           UNION ALL SELECT DISTINCT 'position', position FROM predictions""",
    ),
)
def q5_choices(spark, sf_dir):
    rows = predictions(spark, sf_dir)

    def labelled(kind, df):
        return df.select(F.lit(kind).alias("kind"), F.col(df.columns[0]).cast("string").alias("choice"))

    return (
        labelled("season", seasons_in_order(rows, F.col("game_id")))
        .unionByName(labelled("week", weeks(rows)))
        .unionByName(labelled("player", players(rows, "R#0000001")))
        .unionByName(labelled("position", rows.select("position").distinct()))
    )
