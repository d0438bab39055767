"""Projections, filters and column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonlens.functions.encode import align, fit_indicators, level_index
from seasonlens.functions.exprs import (
    contains_text,
    fill_nulls,
    half_even,
    plain_text,
    quality_counts,
    swap_where,
    to_date_or_null,
    week_label,
    xp_distance,
)
from seasonlens.plans.features import kicks
from seasonlens.queries.registry import query
from seasonlens.queries.roles import GAMES, PLAYS, games, plays, table, with_sql


@query(
    "p_basic",
    with_sql(
        GAMES,
        """SELECT game_id, player_id, player_id AS entity, season, CAST(week + 1 AS INT) AS adj_week, 'K' AS position,
                  pts AS points, CAST(pts AS DOUBLE) AS points_float, CAST(week AS VARCHAR) AS week_text
           FROM games
           WHERE season = 1996 AND priority IN ('1-URGENT', '2-HIGH', '5-LOW')
             AND pts BETWEEN 10000000 AND 40000000 AND week >= 3
           ORDER BY season, adj_week, game_id""",
    ),
)
def p_basic(spark, sf_dir):
    rows = games(spark, sf_dir).where(F.col("season") == 1996)
    rows = rows.where(F.col("priority").isin("1-URGENT", "2-HIGH", "5-LOW"))
    rows = rows.where(F.col("pts").between(10_000_000, 40_000_000) & (F.col("week") >= 3))
    rows = rows.withColumnsRenamed({"pts": "points"}).drop("alt", "game_date", "priority")
    return rows.select(
        "game_id",
        "player_id",
        F.col("player_id").alias("entity"),
        "season",
        (F.col("week") + 1).alias("adj_week"),
        F.lit("K").alias("position"),
        "points",
        F.col("points").cast("double").alias("points_float"),
        F.col("week").cast("string").alias("week_text"),
    ).orderBy("season", "adj_week", "game_id")


FLAGS = """swapped AS (
  SELECT * REPLACE (CASE WHEN play_type = 'kickoff' THEN defteam ELSE posteam END AS posteam,
                    CASE WHEN play_type = 'kickoff' THEN posteam ELSE defteam END AS defteam,
                    TRY_CAST(game_date AS DATE) AS game_date)
  FROM plays WHERE kicker_player_name IS NOT NULL AND play_type IN ('field_goal', 'extra_point', 'kickoff')),
yards AS (SELECT *, CASE WHEN year(game_date) < 2015 THEN 19 ELSE 33 END AS yards FROM swapped),
flags AS (
  SELECT *, extra_point_result IS NOT NULL AND yards = 19 AS xp_attempt_19y,
         extra_point_result IS NOT NULL AND yards = 33 AS xp_attempt_33y,
         coalesce(extra_point_result = 'good', false) AND yards = 19 AS xp_made_19y,
         coalesce(extra_point_result = 'good', false) AND yards = 33 AS xp_made_33y,
         coalesce(field_goal_result = 'made' AND kick_distance >= 50, false) AS "50+_fg_made",
         coalesce(field_goal_result = 'made' AND kick_distance BETWEEN 40 AND 49, false) AS "40-49_fg_made",
         coalesce(field_goal_result = 'made' AND kick_distance < 40, false) AS "0-39_fg_made",
         coalesce(field_goal_result = 'missed' AND kick_distance >= 50, false) AS "missed_fg_50+",
         coalesce(field_goal_result = 'missed' AND kick_distance BETWEEN 40 AND 49, false) AS "missed_fg_40-49",
         coalesce(field_goal_result = 'missed' AND kick_distance < 40, false) AS "missed_fg_0-39"
  FROM yards),
kicks AS (
  SELECT *, CAST("50+_fg_made" AS INT) + CAST("40-49_fg_made" AS INT) + CAST("0-39_fg_made" AS INT) AS total_fg_made,
         CAST("missed_fg_50+" AS INT) + CAST("missed_fg_40-49" AS INT) + CAST("missed_fg_0-39" AS INT)
           AS total_fg_missed
  FROM flags)"""

FLAG_COLUMNS = [
    "xp_attempt_19y", "xp_attempt_33y", "xp_made_19y", "xp_made_33y", "50+_fg_made", "40-49_fg_made", "0-39_fg_made",
    "missed_fg_50+", "missed_fg_40-49", "missed_fg_0-39", "total_fg_made", "total_fg_missed",
]
PLAY_KEY = {"l_orderkey": "a", "l_linenumber": "b", "l_partkey": "c", "l_suppkey": "d"}
QUOTED_FLAGS = ", ".join(f'"{name}"' for name in FLAG_COLUMNS)
SQL_KEY = ", ".join(f"play_id.{short} AS {name}" for name, short in PLAY_KEY.items())


def _play_key():
    return [F.col(f"play_id.{name}").alias(name) for name in PLAY_KEY]


@query("p_flags", with_sql(PLAYS, FLAGS, f"SELECT {SQL_KEY}, game_date, {QUOTED_FLAGS} FROM kicks"))
def p_flags(spark, sf_dir):
    return kicks(plays(spark, sf_dir)).select(*_play_key(), "game_date", *FLAG_COLUMNS)


@query(
    "p_quality",
    with_sql(
        PLAYS,
        """SELECT count(*) FILTER (WHERE play_type = 'kickoff') AS rows_swapped,
                  count(*) FILTER (WHERE TRY_CAST(game_date AS DATE) IS NULL) AS bad_dates,
                  bool_or(TRY_CAST(game_date AS DATE) IS NULL) AS any_missing_date
           FROM plays""",
    ),
)
def p_quality(spark, sf_dir):
    return quality_counts(plays(spark, sf_dir), F.col("play_type") == "kickoff", "game_date")


@query(
    "p_swap",
    """SELECT l_orderkey, l_linenumber, l_returnflag,
              CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE l_suppkey END AS l_suppkey,
              CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE l_partkey END AS l_partkey
       FROM lineitem""",
)
def p_swap(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = rows.select("l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey", "l_partkey")
    return swap_where(rows, F.col("l_returnflag") == "R", "l_suppkey", "l_partkey")


@query(
    "p_fill_round",
    with_sql(
        GAMES,
        """SELECT game_id, coalesce(alt, 0) AS alt, coalesce(nullif(priority, '5-LOW'), '0') AS priority,
                  round_even(pts / 7.0e3 * 100, 0) / 100 AS two, round_even(pts / 7.0e3 * 10, 0) / 10 AS one
           FROM games""",
    ),
)
def p_fill_round(spark, sf_dir):
    rows = games(spark, sf_dir)
    ratio = F.col("pts") / 7.0e3
    rows = rows.select(
        "game_id",
        "alt",
        F.when(F.col("priority") != "5-LOW", F.col("priority")).alias("priority"),
        half_even(ratio, 2).alias("two"),
        half_even(ratio, 1).alias("one"),
    )
    return fill_nulls(rows)


@query(
    "p_text",
    with_sql(
        GAMES,
        """SELECT CAST(game_id AS VARCHAR) AS game_id, 'Week ' || CAST(week AS VARCHAR) AS weeks,
                  replace(priority || ',' || CAST(week AS VARCHAR), ',', '-') AS label
           FROM games WHERE contains(lower(priority), 'spec') OR contains(lower(priority), 'urg')""",
    ),
)
def p_text(spark, sf_dir):
    rows = games(spark, sf_dir).where(contains_text("priority", "SPEC") | contains_text("priority", "Urg"))
    label = F.concat("priority", F.lit(","), F.col("week").cast("string")).alias("label")
    return plain_text(rows.select("game_id", week_label().alias("weeks"), label))


@query(
    "p_dates",
    with_sql(
        GAMES,
        """SELECT game_id, TRY_CAST(raw AS DATE) AS parsed, CAST(year(TRY_CAST(raw AS DATE)) AS INT) AS parsed_year,
                  CASE WHEN year(TRY_CAST(raw AS DATE)) < 2015 THEN 19 ELSE 33 END AS xp_distance
           FROM (SELECT game_id, CASE WHEN game_id % 11 = 0 THEN 'bad'
                   ELSE strftime(game_date + INTERVAL 18 YEAR, '%Y-%m-%d') END AS raw FROM games)""",
    ),
)
def p_dates(spark, sf_dir):
    later = F.date_format(F.add_months(F.col("game_date").cast("date"), 18 * 12), "yyyy-MM-dd")
    rows = games(spark, sf_dir).select("game_id", F.when(F.col("game_id") % 11 != 0, later).otherwise("bad").alias("raw"))
    rows = rows.select("game_id", to_date_or_null("raw").alias("parsed"))
    return rows.select("game_id", "parsed", F.year("parsed").alias("parsed_year"),
                       xp_distance(F.col("parsed")).alias("xp_distance"))


LEVELS = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "p_encode",
    with_sql(
        GAMES,
        "SELECT game_id, pts, "
        + ", ".join(f"CAST(coalesce(priority = '{level}', false) AS INT) AS \"priority_{level}\"" for level in LEVELS)
        + ", 0 AS priority_unseen FROM (SELECT game_id, pts, CASE WHEN week <> 12 THEN priority END AS priority "
        "FROM games)",
    ),
)
def p_encode(spark, sf_dir):
    rows = games(spark, sf_dir).select("game_id", "pts", F.when(F.col("week") != 12, F.col("priority")).alias("priority"))
    encoded = fit_indicators(rows, ["pts", "priority"]).transform(rows)
    return align(encoded, ["game_id", "pts", *[f"priority_{level}" for level in LEVELS], "priority_unseen"])


@query(
    "p_encode_wide",
    """WITH levels AS (SELECT level, CAST(row_number() OVER (ORDER BY level) - 1 AS BIGINT) AS place
                       FROM (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS level FROM lineitem))
       SELECT l_orderkey, l_linenumber, place FROM lineitem JOIN levels ON level = CAST(l_partkey AS VARCHAR)""",
)
def p_encode_wide(spark, sf_dir):
    """The place of every part among all parts, which grow with the table."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("level"))
    return rows.join(level_index(rows, "level"), "level").select("l_orderkey", "l_linenumber", F.col("at").alias("place"))
