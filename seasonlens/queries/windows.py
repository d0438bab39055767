"""History features, running totals and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonlens.operators.history import player_history, side_history
from seasonlens.operators.running import rank_min, running_total
from seasonlens.operators.sets import home_and_away
from seasonlens.queries.registry import query
from seasonlens.queries.roles import GAME_ORDER, GAMES, SHIP_GAMES, games, history_sql, ship_games, with_sql
from seasonlens.session import stage

FIELDS = ["pts", "alt"]
BY_PLAYER = dict(entity="player_id", order="game_date, game_id", fields=FIELDS)


@query("w11_history", with_sql(GAMES, history_sql("h", "games", **BY_PLAYER), "SELECT * FROM h"))
def w11_history(spark, sf_dir):
    return player_history(games(spark, sf_dir), ["player_id"], "season", GAME_ORDER, FIELDS)


@query("w11_nocareer", with_sql(GAMES, history_sql("h", "games", **BY_PLAYER, career=False), "SELECT * FROM h"))
def w11_nocareer(spark, sf_dir):
    return player_history(games(spark, sf_dir), ["player_id"], "season", GAME_ORDER, FIELDS, career=False)


@query("w12_history", with_sql(GAMES, history_sql("h", "games", **BY_PLAYER, base=0, last=False), "SELECT * FROM h"))
def w12_history(spark, sf_dir):
    return side_history(games(spark, sf_dir), ["player_id"], "season", GAME_ORDER, FIELDS)


@query(
    "w12_defence",
    with_sql(
        GAMES,
        history_sql("h", "games", entity="priority", order="game_date, game_id", fields=FIELDS, career=False, base=0,
                    last=False, career_counter=False),
        "SELECT * FROM h",
    ),
)
def w12_defence(spark, sf_dir):
    """Five entities hold all rows: with enough of them each is computed in blocks."""
    return side_history(games(spark, sf_dir), ["priority"], "season", GAME_ORDER, FIELDS, career=False)


SIDES = """sides AS (
  SELECT game_id, season, week, home_team AS team, away_score AS points_allowed, 0 AS is_away FROM {0}
  UNION ALL SELECT game_id, season, week, away_team, home_score, 1 FROM {0})"""


def sides(rows):
    """Home and away view of each game; the flag tells them apart where a team meets itself."""
    rows = rows.withColumns({"at_home": F.lit(0), "on_the_road": F.lit(1)})
    return home_and_away(
        rows,
        ["game_id", "season", "week"],
        home={"team": "home_team", "points_allowed": "away_score", "is_away": "at_home"},
        away={"team": "away_team", "points_allowed": "home_score", "is_away": "on_the_road"},
    )


TOTALS = """totals AS (
  SELECT *, CASE WHEN points_allowed IS NOT NULL THEN sum(points_allowed) OVER (
      PARTITION BY season, team ORDER BY week, game_id, is_away ROWS UNBOUNDED PRECEDING) END AS total
  FROM sides)"""


def staged_sides(spark, sf_dir):
    """Aggregated from line items, then read for group sizes and for the windows: computed once."""
    return stage(sides(ship_games(spark, sf_dir)), "sides")


def totals(rows):
    order = ["week", "game_id", "is_away"]
    return running_total(rows, ["season", "team"], order, "points_allowed", "total")


@query("w_running", with_sql(SHIP_GAMES, SIDES.format("ship_games"), TOTALS, "SELECT * FROM totals"))
def w_running(spark, sf_dir):
    return totals(staged_sides(spark, sf_dir))


@query(
    "w_rank",
    with_sql(
        SHIP_GAMES, SIDES.format("ship_games"), TOTALS,
        """SELECT *, CASE WHEN total IS NOT NULL THEN
             rank() OVER (PARTITION BY season, week ORDER BY total ASC NULLS LAST) END AS place FROM totals""",
    ),
)
def w_rank(spark, sf_dir):
    rows = staged_sides(spark, sf_dir)
    return rank_min(stage(totals(rows), "totals"), ["season", "week"], "total", "place")


# The same operators with a low limit, so that the whole tables take the way of hot groups.
HOT_ROWS = 1_000


@query(
    "w11_history_hot",
    with_sql(GAMES, history_sql("h", "games", entity="priority", order="game_date, game_id", fields=FIELDS),
             "SELECT * FROM h"),
)
def w11_history_hot(spark, sf_dir):
    """Five entities hold all rows; each is computed in blocks."""
    return player_history(games(spark, sf_dir), ["priority"], "season", GAME_ORDER, FIELDS, rows_per_block=HOT_ROWS)


@query(
    "w_running_hot",
    with_sql(
        SHIP_GAMES, SIDES.format("ship_games"),
        """SELECT *, CASE WHEN points_allowed IS NOT NULL THEN sum(points_allowed) OVER (
             PARTITION BY season ORDER BY week, game_id, is_away ROWS UNBOUNDED PRECEDING) END AS total FROM sides""",
    ),
)
def w_running_hot(spark, sf_dir):
    rows = staged_sides(spark, sf_dir)
    return running_total(rows, ["season"], ["week", "game_id", "is_away"], "points_allowed", "total", HOT_ROWS)


@query(
    "w_rank_hot",
    with_sql(
        SHIP_GAMES, SIDES.format("ship_games"),
        """SELECT *, CASE WHEN points_allowed IS NOT NULL THEN
             rank() OVER (PARTITION BY season ORDER BY points_allowed ASC NULLS LAST) END AS place FROM sides""",
    ),
)
def w_rank_hot(spark, sf_dir):
    """Few values and many ties: equal values are counted before they are ranked."""
    return rank_min(staged_sides(spark, sf_dir), ["season"], "points_allowed", "place", HOT_ROWS)
