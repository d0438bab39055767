"""Lookups, context joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonlens.functions.feature_lists import KICK_TOTALS
from seasonlens.operators.joins import null_safe_join, previous_period, replace_names, spread_join, suffix_join
from seasonlens.operators.sets import (
    add_to_selection,
    distinct_rows,
    once,
    remove_from_selection,
    union_by_name,
)
from seasonlens.plans.defence import points_given_up
from seasonlens.plans.features import (
    kicker_games,
    kicks,
    passer_context,
    quarterback_weeks,
    rusher_receiver_weeks,
    stadium_context,
    team_context,
)
from seasonlens.queries.columns import FLAGS
from seasonlens.queries.registry import query
from seasonlens.queries.roles import (
    GAMES,
    PLAYS,
    SCHEDULES,
    SHIP_GAMES,
    USER_WEEKS,
    WEEKLY,
    games,
    null_if,
    plays,
    rosters,
    schedules,
    ship_games,
    table,
    user_weeks,
    weekly,
    with_sql,
)
from seasonlens.queries.windows import SIDES, sides
from seasonlens.session import stage


@query(
    "j_prev_week",
    with_sql(
        USER_WEEKS,
        """SELECT a.*, b.pts AS last_pts FROM user_weeks a LEFT JOIN user_weeks b
           ON a.player_id = b.player_id AND a.season = b.season AND a.week = b.week + 1""",
    ),
)
def j_prev_week(spark, sf_dir):
    return previous_period(user_weeks(spark, sf_dir), ["player_id", "season"], "week", "pts", "last_pts")


@query(
    "j_prev_week_hot",
    with_sql(
        USER_WEEKS,
        """SELECT a.*, b.pts AS last_pts FROM user_weeks a LEFT JOIN user_weeks b
           ON a.player_id = b.player_id AND a.season = b.season AND a.week = b.week + 1""",
    ),
)
def j_prev_week_hot(spark, sf_dir):
    """The same lookup, with a key counted as hot as soon as it repeats."""
    return previous_period(user_weeks(spark, sf_dir), ["player_id", "season"], "week", "pts", "last_pts", rows=1)


@query(
    "j_prev_week_pos",
    with_sql(
        USER_WEEKS,
        """SELECT a.*, b.pts AS last_pts FROM user_weeks a LEFT JOIN user_weeks b
           ON a.player_id = b.player_id AND a.season = b.season AND a.position = b.position AND a.week = b.week + 1""",
    ),
)
def j_prev_week_pos(spark, sf_dir):
    return previous_period(user_weeks(spark, sf_dir), ["player_id", "season", "position"], "week", "pts", "last_pts")


STAT_NAMES = "carries, rushing_yards, receptions, fantasy_points_ppr"


def player_weeks_sql(stats: str, not_of_quarterbacks: str = "carries") -> str:
    return f"""players AS (
  SELECT player_id, player_name, season, week, position, recent_team AS team, season_type, opponent_team, {stats}
  FROM weekly),
rw AS (
  SELECT a.*, b.fantasy_points_ppr AS player_last_fp
  FROM (SELECT * FROM players WHERE position IN ('WR','RB','TE','FB')) a
  LEFT JOIN players b ON a.player_name = b.player_name AND a.season = b.season AND a.team = b.team
    AND a.position = b.position AND a.week = b.week + 1),
qb AS (
  SELECT a.* EXCLUDE ({not_of_quarterbacks}), b.fantasy_points_ppr AS player_last_fp
  FROM (SELECT * FROM players WHERE position = 'QB') a
  LEFT JOIN (SELECT * FROM players WHERE position = 'QB') b
    ON a.player_name = b.player_name AND a.season = b.season AND a.team = b.team AND a.week = b.week + 1)"""


PLAYER_WEEKS = player_weeks_sql(STAT_NAMES)

CONTEXT = """team_context AS (
  SELECT game_id, week, season, spread_line, game_date, div_game, posteam AS team,
         arg_min(wind, play_id) FILTER (WHERE wind IS NOT NULL) AS wind,
         arg_min(roof, play_id) FILTER (WHERE roof IS NOT NULL) AS roof
  FROM plays WHERE spread_line IS NOT NULL AND game_date IS NOT NULL AND posteam IS NOT NULL
  GROUP BY ALL),
passer_context AS (
  SELECT passer_player_id, game_id, week, season, passer_player_name AS player_name, spread_line, game_date, div_game,
         arg_min(wind, play_id) FILTER (WHERE wind IS NOT NULL) AS wind,
         arg_min(roof, play_id) FILTER (WHERE roof IS NOT NULL) AS roof
  FROM plays WHERE spread_line IS NOT NULL AND game_date IS NOT NULL AND passer_player_name IS NOT NULL
  GROUP BY ALL)"""

LEAGUE = [GAMES, WEEKLY, PLAYS, PLAYER_WEEKS, CONTEXT]


@query("j_context", with_sql(*LEAGUE, "SELECT * FROM rw JOIN team_context USING (team, week, season)"))
def j_context(spark, sf_dir):
    return rusher_receiver_weeks(weekly(spark, sf_dir), STAT_NAMES.split(", "), context=team_context(plays(spark, sf_dir)))


@query("j_context_name", with_sql(*LEAGUE, "SELECT * FROM qb JOIN passer_context USING (player_name, week, season)"))
def j_context_name(spark, sf_dir):
    players = quarterback_weeks(weekly(spark, sf_dir), STAT_NAMES.split(", ")[1:])
    return players.join(passer_context(plays(spark, sf_dir)), ["player_name", "week", "season"])


@query(
    "j_nullsafe",
    """SELECT a.c_custkey, a.grp, b.s_suppkey
       FROM (SELECT c_custkey, nullif(c_custkey % 97, 5) AS grp FROM customer) a
       JOIN (SELECT s_suppkey, nullif(s_suppkey % 97, 5) AS grp FROM supplier) b
       ON a.grp IS NOT DISTINCT FROM b.grp""",
)
def j_nullsafe(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select("c_custkey", null_if(F.col("c_custkey") % 97, 5).alias("grp"))
    right = table(spark, sf_dir, "supplier").select("s_suppkey", null_if(F.col("s_suppkey") % 97, 5).alias("grp"))
    return spread_join(left, right, ["grp"])


@query(
    "j_fanout",
    with_sql(
        *LEAGUE[:2], SCHEDULES, PLAYER_WEEKS,
        SIDES.format("schedules"),
        """SELECT game_id, s.season, s.week AS week_of_interest, s.team AS opponent_team, points_allowed, is_away,
                  CAST(s.week + 1 AS INT) AS week, position, fantasy_points_ppr AS prior_allowed_fp
           FROM sides s LEFT JOIN rw ON s.week = rw.week AND s.season = rw.season AND s.team = rw.opponent_team""",
    ),
)
def j_fanout(spark, sf_dir):
    allowed = sides(schedules(spark, sf_dir)).withColumnRenamed("team", "opponent_team")
    players = rusher_receiver_weeks(weekly(spark, sf_dir), STAT_NAMES.split(", "))
    return points_given_up(allowed.withColumn("adj_week", F.col("week") + 1), players)


KICK_SUMS = ", ".join(
    f'CAST(sum(CAST("{name}" AS INT)) AS BIGINT) AS "{name}"'
    for name in KICK_TOTALS
)
KICKER_GAMES = f"""kick_totals AS (
  SELECT game_id, game_date, week, season, posteam, defteam AS opponent_team, kicker_player_name AS player_name,
         kicker_player_id AS player_id,
         arg_min(home_team, play_id) FILTER (WHERE home_team IS NOT NULL) AS home_team,
         arg_min(away_team, play_id) FILTER (WHERE away_team IS NOT NULL) AS away_team, {KICK_SUMS}
  FROM kicks WHERE game_date IS NOT NULL AND posteam IS NOT NULL AND defteam IS NOT NULL
  GROUP BY game_id, game_date, week, season, posteam, defteam, kicker_player_name, kicker_player_id),
kicker_games AS (
  SELECT k.*, fantasy_points_ppr, coalesce(home_team = posteam, false) AS home
  FROM kick_totals k JOIN (SELECT player_id, week, season, fantasy_points_ppr FROM weekly)
  USING (player_id, week, season))"""
STADIUM = """stadium AS (
  SELECT game_id, game_date, week, season, stadium,
         arg_min(home_team, play_id) FILTER (WHERE home_team IS NOT NULL) AS home_team,
         arg_min(roof, play_id) FILTER (WHERE roof IS NOT NULL) AS roof,
         arg_min(temp, play_id) FILTER (WHERE temp IS NOT NULL) AS temp,
         arg_min(wind, play_id) FILTER (WHERE wind IS NOT NULL) AS wind
  FROM kicks WHERE game_date IS NOT NULL AND stadium IS NOT NULL GROUP BY ALL)"""
KICKING = [GAMES, WEEKLY, PLAYS, FLAGS, KICKER_GAMES]


@query("j_inner_multi", with_sql(*KICKING, "SELECT * FROM kicker_games"))
def j_inner_multi(spark, sf_dir):
    return kicker_games(kicks(plays(spark, sf_dir)), weekly(spark, sf_dir))


@query(
    "j_suffix",
    with_sql(
        USER_WEEKS,
        """SELECT a.player_id, a.season, a.week, a.position AS position_k, a.pts AS pts_k, b.n, b.pts AS pts_def
           FROM user_weeks a LEFT JOIN (
             SELECT player_id, season, week, CAST(sum(pts) AS BIGINT) AS pts, count(*) AS n
             FROM user_weeks WHERE position = 'click' GROUP BY ALL) b USING (player_id, season, week)""",
    ),
)
def j_suffix(spark, sf_dir):
    rows = user_weeks(spark, sf_dir)
    on = ["player_id", "season", "week"]
    # totals of one event type only, so that weeks of the others find nothing
    days = rows.where(F.col("position") == "click").groupBy(*on).agg(F.sum("pts").alias("pts"), F.count(F.lit(1)).alias("n"))
    return suffix_join(rows, days, on, ("_k", "_def")).withColumnRenamed("position", "position_k")


@query(
    "j_levels",
    with_sql(
        *KICKING, STADIUM,
        """SELECT g.player_id, g.game_id, g.game_date, g.week, g.season, s.home_team, s.roof, s.temp, s.wind
           FROM kicker_games g LEFT JOIN stadium s
           ON g.game_id = s.game_id AND g.game_date = s.game_date AND g.week = s.week AND g.season = s.season""",
    ),
)
def j_levels(spark, sf_dir):
    rows = kicks(plays(spark, sf_dir))
    on = ["game_id", "game_date", "week", "season"]
    played = kicker_games(rows, weekly(spark, sf_dir)).select("player_id", *on)
    return null_safe_join(played, stadium_context(rows).drop("stadium"), on, "left")


@query(
    "j_reattach",
    with_sql(
        *KICKING,
        """SELECT a.game_id, a.player_id, a.posteam, b.fantasy_points_ppr
           FROM kicker_games a LEFT JOIN kicker_games b USING (game_id, player_id)""",
    ),
)
def j_reattach(spark, sf_dir):
    """Both sides are the same reduced table, so it is written once and read twice."""
    keys = ["game_id", "player_id"]
    played = kicker_games(kicks(plays(spark, sf_dir)), weekly(spark, sf_dir))
    played = stage(played.select(*keys, "posteam", "fantasy_points_ppr"), "kicker-games")
    return null_safe_join(played.select(*keys, "posteam"), played.select(*keys, "fantasy_points_ppr"), keys, "left")


@query(
    "j_roster",
    with_sql(
        GAMES, WEEKLY,
        """rosters AS (SELECT CAST(o_custkey AS VARCHAR) AS player_id, c_name AS player_name
                       FROM orders JOIN customer ON o_custkey = c_custkey)""",
        """SELECT DISTINCT w.player_id, season, week, fantasy_points_ppr, r.player_name
           FROM weekly w JOIN rosters r ON w.player_id = r.player_id""",
    ),
)
def j_roster(spark, sf_dir):
    """The SQL joins every roster row and then removes duplicates; here the roster is made distinct first."""
    rows = weekly(spark, sf_dir).select("player_id", "player_name", "season", "week", "fantasy_points_ppr")
    return distinct_rows(replace_names(rows, rosters(spark, sf_dir)))


@query(
    "u_home_away",
    with_sql(SHIP_GAMES, SIDES.format("ship_games"), "SELECT * FROM sides"),
)
def u_home_away(spark, sf_dir):
    return sides(ship_games(spark, sf_dir))


@query(
    "u_missing_cols",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL BY NAME SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
       UNION ALL BY NAME SELECT p_partkey AS id, p_name AS name, p_brand AS brand FROM part""",
)
def u_missing_cols(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return union_by_name(customers, suppliers, parts)


@query(
    "u_selection",
    """SELECT o_custkey AS player FROM orders WHERE o_orderstatus = 'F'
       UNION SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
       EXCEPT SELECT o_custkey FROM orders WHERE month(o_orderdate) = 6""",
)
def u_selection(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    player = F.col("o_custkey").alias("player")
    selected = orders.where(F.col("o_orderstatus") == "F").select(player).distinct()
    added = orders.where(F.col("o_orderpriority") == "1-URGENT").select(player)
    removed = orders.where(F.month("o_orderdate") == 6).select(player)
    return remove_from_selection(add_to_selection(selected, added), removed)


@query(
    "u_selection_lists",
    """SELECT c_custkey,
              array_to_string(list_sort(list_distinct([c_name, c_mktsegment, c_mktsegment, 'ALL'])), ',') AS added,
              array_to_string(list_sort(list_filter([c_name, c_mktsegment], lambda x: x <> 'BUILDING')), ',') AS kept
       FROM customer""",
)
def u_selection_lists(spark, sf_dir):
    """The same on a row's own list of choices."""
    names = F.array("c_name", "c_mktsegment")
    added = F.array_union(names, F.array(F.col("c_mktsegment"), F.lit("ALL")))
    kept = F.array_except(names, F.array(F.lit("BUILDING")))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.array_join(F.sort_array(added), ",").alias("added"),
        F.array_join(F.sort_array(kept), ",").alias("kept"),
    )


@query(
    "u_once",
    with_sql(
        GAMES,
        """SELECT player_id, season, game_id, pts FROM (
             SELECT *, row_number() OVER (PARTITION BY player_id, season ORDER BY game_date, game_id) AS n FROM games)
           WHERE n = 1""",
    ),
)
def u_once(spark, sf_dir):
    rows = games(spark, sf_dir).select("player_id", "season", "game_date", "game_id", "pts")
    return once(rows, ["player_id", "season"], F.struct("game_date", "game_id")).drop("game_date")
