"""Totals, distinct values, metrics and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonlens.functions.exprs import half_even
from seasonlens.functions.feature_lists import KICKER_STATS
from seasonlens.operators.metrics import bounds, long_metrics, metric_matrix, regression_metrics
from seasonlens.operators.sets import choices, first_seen
from seasonlens.plans.features import defence_games, kicker_games, kicks
from seasonlens.plans.views import top_rows
from seasonlens.queries.joins import KICKING
from seasonlens.queries.registry import query
from seasonlens.queries.roles import GAMES, PREDICTIONS, games, plays, predictions, table, weekly, with_sql

SUMS = KICKER_STATS
DEFENCE_SUMS = ", ".join(
    f'CAST(sum("{name}") AS {"DOUBLE" if name == "fantasy_points_ppr" else "BIGINT"}) AS "{name}"' for name in SUMS
)
DEFENCE_GAMES = f"""defence_games AS (
  SELECT game_id, game_date, week, season, posteam, opponent_team, home_team, away_team, {DEFENCE_SUMS}
  FROM kicker_games WHERE home_team IS NOT NULL AND away_team IS NOT NULL GROUP BY ALL)"""


@query("a_game_totals", with_sql(*KICKING, "SELECT * EXCLUDE (home, fantasy_points_ppr) FROM kicker_games"))
def a_game_totals(spark, sf_dir):
    return kicker_games(kicks(plays(spark, sf_dir)), weekly(spark, sf_dir)).drop("home", "fantasy_points_ppr")


@query("a_def_totals", with_sql(*KICKING, DEFENCE_GAMES, "SELECT * FROM defence_games"))
def a_def_totals(spark, sf_dir):
    return defence_games(kicker_games(kicks(plays(spark, sf_dir)), weekly(spark, sf_dir)))


@query("a_distinct", "SELECT DISTINCT c_name AS player_name FROM customer JOIN orders ON c_custkey = o_custkey ORDER BY 1")
def a_distinct(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("player_name"))
    rows = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return choices(rows, "player_name")


@query("a_first_seen", with_sql(GAMES, "SELECT season, min(game_id) AS first_seen FROM games GROUP BY season ORDER BY 2"))
def a_first_seen(spark, sf_dir):
    return first_seen(games(spark, sf_dir), "season", F.col("game_id"))


@query(
    "a_bounds",
    """SELECT least(0.0::DOUBLE, min(c_acctbal), min(c_acctbal * 2 - 100)) AS lower_bound,
              count(*) FILTER (WHERE c_acctbal < 0) AS below_zero,
              bool_or(nullif(c_mktsegment, 'MACHINERY') IS NULL) AS any_null
       FROM customer""",
)
def a_bounds(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("twice", F.col("c_acctbal") * 2 - 100)
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    return rows.agg(
        F.least(F.lit(0.0), F.min("c_acctbal"), F.min("twice")).alias("lower_bound"),
        F.count_if(F.col("c_acctbal") < 0).alias("below_zero"),
        F.bool_or(segment.isNull()).alias("any_null"),
    )


@query(
    "a_bounds_view",
    with_sql(GAMES, PREDICTIONS, """SELECT least(0.0::DOUBLE, min(predicted_fantasy), min(fantasy_points_ppr - 30))
                                      AS lower_bound FROM predictions"""),
)
def a_bounds_view(spark, sf_dir):
    rows = predictions(spark, sf_dir).withColumn("shifted", F.col("fantasy_points_ppr") - 30)
    return bounds(rows, ["predicted_fantasy", "shifted"])


METRICS_SQL = """metrics AS (
  SELECT position, avg(abs(y - p)) AS "MAE", avg((y - p) * (y - p)) AS "MSE",
         1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS "R2"
  FROM (SELECT position, fantasy_points_ppr AS y, predicted_fantasy AS p FROM predictions)
  WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY position)"""


@query(
    "a_metrics",
    with_sql(GAMES, PREDICTIONS, METRICS_SQL,
             'SELECT position, round_even("MAE" * 1e6, 0) / 1e6 AS "MAE", round_even("MSE" * 1e6, 0) / 1e6 AS "MSE", '
             'round_even("R2" * 1e6, 0) / 1e6 AS "R2" FROM metrics'),
)
def a_metrics(spark, sf_dir):
    found = regression_metrics(predictions(spark, sf_dir), "fantasy_points_ppr", "predicted_fantasy", ["position"])
    return found.withColumns({name: half_even(name, 6) for name in ("MAE", "MSE", "R2")})


@query(
    "a_matrix",
    with_sql(
        GAMES, PREDICTIONS, METRICS_SQL,
        """long AS (UNPIVOT metrics ON "MAE", "MSE", "R2" INTO NAME metric VALUE value)""",
        "SELECT metric, "
        + ", ".join(f"round_even(max(value) FILTER (WHERE position = '{p}') * 1e6, 0) / 1e6 AS \"{p}\""
                    for p in ("QB", "RB", "WR", "TE", "K"))
        + ", CAST(NULL AS DOUBLE) AS \"FB\" FROM long GROUP BY metric",
    ),
)
def a_matrix(spark, sf_dir):
    found = regression_metrics(predictions(spark, sf_dir), "fantasy_points_ppr", "predicted_fantasy", ["position"])
    long = long_metrics(found).withColumnRenamed("position", "model").withColumn("value", half_even("value", 6))
    return metric_matrix(long, ["QB", "RB", "WR", "TE", "K", "FB"])


@query("o_topk", with_sql(GAMES, "SELECT * FROM games ORDER BY alt DESC NULLS LAST, game_id LIMIT 32"))
def o_topk(spark, sf_dir):
    return top_rows(games(spark, sf_dir), "alt", 32, ["game_id"])


@query(
    "o_topk_filtered",
    with_sql(GAMES, "SELECT * FROM games WHERE priority = '2-HIGH' ORDER BY alt DESC NULLS LAST, game_id LIMIT 32"),
)
def o_topk_filtered(spark, sf_dir):
    return top_rows(games(spark, sf_dir).where(F.col("priority") == "2-HIGH"), "alt", 32, ["game_id"])
