"""The test tables in the roles of the season tables, as DataFrames and as SQL.

``orders`` are games of customers, ``events`` weekly points of users, ``lineitem`` plays. The
test tables have no nulls, so some are made by expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlens.functions.feature_lists import QUARTERBACK_STATS, RUSHER_RECEIVER_CARRIED, RUSHER_RECEIVER_STATS
from seasonlens.operators.history import player_history
from seasonlens.sources.readers import SeasonTables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_if(column: Column, value) -> Column:
    return F.when(column != value, column)


# --- games: one row per order -------------------------------------------------------------

GAME_ORDER = ["game_date", "game_id"]


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("game_id"),
        F.col("o_custkey").alias("player_id"),
        F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("week"),
        F.col("o_orderdate").alias("game_date"),
        F.col("o_orderpriority").alias("priority"),
        cents.alias("pts"),
        (null_if(cents % 5, 0) * cents).alias("alt"),
    )


GAMES = """games AS (
  SELECT o_orderkey AS game_id, o_custkey AS player_id, CAST(year(o_orderdate) AS INT) AS season,
         CAST(month(o_orderdate) AS INT) AS week, o_orderdate AS game_date, o_orderpriority AS priority,
         CAST(round(o_totalprice * 100) AS BIGINT) AS pts,
         nullif(CAST(round(o_totalprice * 100) AS BIGINT) % 5, 0) * CAST(round(o_totalprice * 100) AS BIGINT) AS alt
  FROM orders)"""


# --- weekly points of users ---------------------------------------------------------------


def user_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("player_id"),
        F.year("ts").alias("season"),
        F.dayofmonth("ts").alias("week"),
        F.col("event_type").alias("position"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
    )
    return events.groupBy("player_id", "season", "week", "position").agg(F.sum("cents").alias("pts"))


USER_WEEKS = """user_weeks AS (
  SELECT user_id AS player_id, CAST(year(ts) AS INT) AS season, CAST(day(ts) AS INT) AS week,
         event_type AS position, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS pts
  FROM events GROUP BY ALL)"""


# --- a league: weekly statistics of customers, plays of their orders ------------------------

TEAMS, NAMES = 25, 1200
STATS = ["rushing_yards", "receptions", "fantasy_points_ppr"]
CARRIED = ["carries"]
#: the other statistics that the groups use: remainders of an order's cents, null where they are zero
MORE_STATS = [name for name in dict.fromkeys([*RUSHER_RECEIVER_STATS, *QUARTERBACK_STATS, *RUSHER_RECEIVER_CARRIED])
              if name not in (*STATS, *CARRIED)]


def _player(custkey: str = "o_custkey") -> list[Column]:
    key = F.col(custkey)
    position = F.element_at(F.array(*[F.lit(p) for p in ("QB", "RB", "WR", "TE", "FB", "K")]),
                            (key % 6 + 1).cast("int"))
    return [
        key.cast("string").alias("player_id"),
        F.concat(F.lit("P"), (key % NAMES).cast("string")).alias("player_name"),
        position.alias("position"),
    ]


def _team(number: Column) -> Column:
    return F.concat(F.lit("T"), number.cast("string"))


def weekly(spark: SparkSession, sf_dir: str, more: Sequence[str] = ()) -> DataFrame:
    totals = games(spark, sf_dir).groupBy("player_id", "season", "week").agg(
        F.sum("pts").cast("double").alias("fantasy_points_ppr"),
        F.sum("alt").cast("double").alias("rushing_yards"),
        F.sum(null_if(F.col("pts") % 7, 0)).cast("double").alias("receptions"),
        F.count(F.lit(1)).cast("double").alias("carries"),
        *[F.sum(null_if((F.col("pts") + 31 * at) % (11 + at), 0)).cast("double").alias(name) for at, name in enumerate(more)],
    )
    key = F.col("player_id")
    return totals.select(
        *_player("player_id"),
        "season",
        "week",
        _team(key % TEAMS).alias("recent_team"),
        F.lit("REG").alias("season_type"),
        _team(F.pmod(F.col("week") - key % TEAMS, F.lit(TEAMS))).alias("opponent_team"),
        *CARRIED,
        *STATS,
        *more,
    )


def weekly_sql(more: Sequence[str] = ()) -> str:
    made = "".join(f", CAST(sum(nullif((pts + {31 * at}) % {11 + at}, 0)) AS DOUBLE) AS {name}" for at, name in enumerate(more))
    return f"""weekly AS (
  SELECT CAST(player_id AS VARCHAR) AS player_id, 'P' || CAST(player_id % {NAMES} AS VARCHAR) AS player_name,
         (['QB','RB','WR','TE','FB','K'])[player_id % 6 + 1] AS position, season, week,
         'T' || CAST(player_id % {TEAMS} AS VARCHAR) AS recent_team, 'REG' AS season_type,
         'T' || CAST((week - player_id % {TEAMS} + {TEAMS}) % {TEAMS} AS VARCHAR) AS opponent_team,
         CAST(count(*) AS DOUBLE) AS carries,
         CAST(sum(alt) AS DOUBLE) AS rushing_yards,
         CAST(sum(nullif(pts % 7, 0)) AS DOUBLE) AS receptions,
         CAST(sum(pts) AS DOUBLE) AS fantasy_points_ppr{made}
  FROM games GROUP BY games.player_id, season, week)"""


WEEKLY = weekly_sql()


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as plays: teams meet in pairs each month, some dates and spreads are unknown."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week")
    )
    rows = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    own = F.col("o_custkey") % TEAMS
    rows = rows.withColumns({"own": own, "opp": F.pmod(F.col("week") - own, F.lit(TEAMS))})
    rows = rows.withColumns({"lo": F.least("own", "opp"), "hi": F.greatest("own", "opp")})
    lo, hi, season, week = F.col("lo"), F.col("hi"), F.col("season"), F.col("week")
    kind = F.when(F.col("l_linenumber") == 7, "pass").otherwise(
        F.when(F.col("l_returnflag") == "A", "field_goal")
        .when(F.col("l_returnflag") == "N", "extra_point")
        .otherwise("kickoff")
    )
    rows = rows.withColumn("play_type", kind)
    flipped = F.col("l_returnflag") == "R"
    outcome = F.element_at(F.array(*[F.lit(x) for x in ("made", "made", "missed", "blocked")]),
                           (F.col("l_partkey") % 4 + 1).cast("int"))
    player_id, player_name, _ = _player()
    return rows.select(
        F.concat_ws("_", season, week, lo, hi).alias("game_id"),
        _team(F.when(flipped, F.col("opp")).otherwise(F.col("own"))).alias("posteam"),
        _team(F.when(flipped, F.col("own")).otherwise(F.col("opp"))).alias("defteam"),
        _team(lo).alias("home_team"),
        _team(hi).alias("away_team"),
        F.concat(F.lit("S"), lo.cast("string")).alias("stadium"),
        null_if(F.col("l_linestatus"), "F").alias("roof"),
        "season",
        "week",
        ((lo + hi) % 2).cast("int").alias("div_game"),
        F.when((season * 12 + week + lo) % 17 == 0, "unknown")
        .otherwise(F.make_date(season, week, (lo * hi % 28 + 1).cast("int")).cast("string"))
        .alias("game_date"),
        null_if((season + week + lo) % 7, 0).cast("double").alias("spread_line"),
        null_if(F.col("l_quantity") % 4, 0.0).alias("wind"),
        (null_if(F.col("l_quantity") % 5, 0.0) * 10).alias("temp"),
        null_if(F.col("l_quantity") + 10, 35.0).alias("kick_distance"),
        player_id.alias("passer_player_id"),
        player_name.alias("passer_player_name"),
        player_id.alias("kicker_player_id"),
        F.when(F.col("l_linenumber") != 6, player_name).alias("kicker_player_name"),
        "play_type",
        F.when(F.col("play_type") == "extra_point",
               F.when(F.col("l_linestatus") == "O", "good").otherwise("failed")).alias("extra_point_result"),
        F.when(F.col("play_type") == "field_goal", outcome).alias("field_goal_result"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("play_id"),
    )


PLAYS = f"""paired AS (
  SELECT *, least(own, opp) AS lo, greatest(own, opp) AS hi,
         CASE WHEN l_linenumber = 7 THEN 'pass' WHEN l_returnflag = 'A' THEN 'field_goal'
              WHEN l_returnflag = 'N' THEN 'extra_point' ELSE 'kickoff' END AS play_type
  FROM (SELECT l.*, o_custkey, CAST(year(o_orderdate) AS INT) AS season, CAST(month(o_orderdate) AS INT) AS week,
               o_custkey % {TEAMS} AS own,
               (CAST(month(o_orderdate) AS INT) - o_custkey % {TEAMS} + {TEAMS}) % {TEAMS} AS opp
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey)),
plays AS (
  SELECT concat_ws('_', season, week, lo, hi) AS game_id,
         'T' || CAST(CASE WHEN l_returnflag = 'R' THEN opp ELSE own END AS VARCHAR) AS posteam,
         'T' || CAST(CASE WHEN l_returnflag = 'R' THEN own ELSE opp END AS VARCHAR) AS defteam,
         'T' || CAST(lo AS VARCHAR) AS home_team, 'T' || CAST(hi AS VARCHAR) AS away_team,
         'S' || CAST(lo AS VARCHAR) AS stadium, nullif(l_linestatus, 'F') AS roof, season, week,
         CAST((lo + hi) % 2 AS INT) AS div_game,
         CASE WHEN (season * 12 + week + lo) % 17 = 0 THEN 'unknown'
              ELSE printf('%d-%02d-%02d', season, week, lo * hi % 28 + 1) END AS game_date,
         CAST(nullif((season + week + lo) % 7, 0) AS DOUBLE) AS spread_line,
         nullif(l_quantity % 4, 0) AS wind, nullif(l_quantity % 5, 0) * 10 AS temp,
         nullif(l_quantity + 10, 35) AS kick_distance,
         CAST(o_custkey AS VARCHAR) AS passer_player_id, 'P' || CAST(o_custkey % {NAMES} AS VARCHAR) AS passer_player_name,
         CAST(o_custkey AS VARCHAR) AS kicker_player_id,
         CASE WHEN l_linenumber <> 6 THEN 'P' || CAST(o_custkey % {NAMES} AS VARCHAR) END AS kicker_player_name,
         play_type,
         CASE WHEN play_type = 'extra_point' THEN CASE WHEN l_linestatus = 'O' THEN 'good' ELSE 'failed' END END
           AS extra_point_result,
         CASE WHEN play_type = 'field_goal' THEN (['made','made','missed','blocked'])[l_partkey % 4 + 1] END
           AS field_goal_result,
         struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey, d := l_suppkey, e := l_extendedprice) AS play_id
  FROM paired)"""


def ship_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items summed to one game per (season, week, home, away); some games have no score yet."""
    home = F.col("l_suppkey").cast("string")
    return _scored(table(spark, sf_dir, "lineitem"), home, (F.col("l_partkey") % 100).cast("string"))


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The league's games: the same monthly pairs as in ``plays``, scored by what was shipped."""
    rows = table(spark, sf_dir, "lineitem")
    own = F.col("l_suppkey") % TEAMS
    opp = F.pmod(F.month("l_shipdate") - own, F.lit(TEAMS))
    return _scored(rows, _team(F.least(own, opp)), _team(F.greatest(own, opp)))


def _scored(rows: DataFrame, home: Column, away: Column) -> DataFrame:
    keys = [F.year("l_shipdate").alias("season"), F.month("l_shipdate").alias("week"),
            home.alias("home_team"), away.alias("away_team")]
    return (
        rows.groupBy(*keys)
        .agg(
            null_if(F.sum("l_quantity") % 6, 0.0).alias("home_score"),
            F.sum(null_if(F.col("l_linenumber"), 3)).cast("double").alias("away_score"),
        )
        .withColumn("game_id", F.concat_ws("_", "season", "week", "home_team", "away_team"))
    )


def _scored_sql(name: str, home: str, away: str) -> str:
    return f"""{name} AS (
  SELECT *, concat_ws('_', season, week, home_team, away_team) AS game_id
  FROM (SELECT CAST(year(l_shipdate) AS INT) AS season, CAST(month(l_shipdate) AS INT) AS week,
               {home} AS home_team, {away} AS away_team, nullif(sum(l_quantity) % 6, 0) AS home_score,
               CAST(sum(nullif(l_linenumber, 3)) AS DOUBLE) AS away_score
        FROM lineitem GROUP BY ALL))"""


SHIP_GAMES = _scored_sql("ship_games", "CAST(l_suppkey AS VARCHAR)", "CAST(l_partkey % 100 AS VARCHAR)")

_OWN = f"l_suppkey % {TEAMS}"
_OPP = f"(CAST(month(l_shipdate) AS INT) - l_suppkey % {TEAMS} + {TEAMS}) % {TEAMS}"
SCHEDULES = _scored_sql("schedules", f"'T' || CAST(least({_OWN}, {_OPP}) AS VARCHAR)",
                        f"'T' || CAST(greatest({_OWN}, {_OPP}) AS VARCHAR)")


def rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and order year: many rows per player."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return games(spark, sf_dir).join(customers, F.col("player_id") == F.col("c_custkey")).select(
        F.col("player_id").cast("string").alias("player_id"), F.col("c_name").alias("player_name"), "season"
    )


def season_tables(spark: SparkSession, sf_dir: str) -> SeasonTables:
    return SeasonTables(rosters(spark, sf_dir), plays(spark, sf_dir), schedules(spark, sf_dir), weekly(spark, sf_dir, MORE_STATS))


# --- predictions: the mean of the last five games --------------------------------------------


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = player_history(games(spark, sf_dir), ["player_id"], "season", GAME_ORDER, ["pts"], career=False)
    position = F.element_at(F.array(*[F.lit(p) for p in ("QB", "RB", "WR", "TE", "K")]),
                            F.substring("priority", 1, 1).cast("int"))
    return rows.select(
        "game_id",
        "player_id",
        F.format_string("Customer#%09d", "player_id").alias("player_name"),
        position.alias("position"),
        "season",
        "week",
        (F.col("pts") / 1e6).alias("fantasy_points_ppr"),
        (F.col("pts_mean_last5") / 1e6).alias("predicted_fantasy"),
        F.col("alt").alias("rushing_yards"),
        null_if(F.col("pts") % 3, 0).alias("receptions"),
    )


PREDICTIONS = """predictions AS (
  SELECT game_id, player_id, printf('Customer#%09d', player_id) AS player_name,
         (['QB','RB','WR','TE','K'])[CAST(substr(priority, 1, 1) AS INT)] AS position, season, week,
         pts / 1e6 AS fantasy_points_ppr,
         avg(pts) OVER (PARTITION BY player_id ORDER BY season, game_date, game_id
                        ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) / 1e6 AS predicted_fantasy,
         alt AS rushing_yards, nullif(pts % 3, 0) AS receptions
  FROM games)"""


# --- shared SQL ------------------------------------------------------------------------------


def mean_sql(field: str, window: str) -> str:
    """The sum divided once. DuckDB's avg of integers is off in the last digit for a few rows of large sums."""
    return f'CAST(sum("{field}") OVER ({window}) AS DOUBLE) / nullif(count("{field}") OVER ({window}), 0)'


def with_sql(*parts: str) -> str:
    """Common table expressions followed by the final SELECT."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def history_sql(name: str, source: str, entity: str, order: str, fields: Sequence[str], *, career: bool = True,
                base: int = 1, last: bool = True, career_counter: bool = True, digits: int | None = None) -> str:
    """The history features of ``source`` as a common table expression ``name``."""
    by_career = f"PARTITION BY {entity} ORDER BY season, {order}"
    by_season = f"PARTITION BY {entity}, season ORDER BY {order}"
    rounded = "{}" if digits is None else f"round_even(({{}}) * 1e{digits}, 0) / 1e{digits}"
    to_date = f"{by_season} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    inner = [f'{mean_sql(f, to_date)} AS "__td_{f}"' for f in fields]
    outer = [f"row_number() OVER ({by_season}) + {base - 1} AS n_games_season"]
    if career_counter:
        outer.append(f"row_number() OVER ({by_career}) + {base - 1} AS n_games_career")
    for f in fields:
        kinds = {"mean_season": f'lag("__td_{f}") OVER ({by_career})',
                 "mean_last5": mean_sql(f, f"{by_career} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING")}
        if career:
            kinds["mean_career"] = mean_sql(f, f"{by_career} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
        outer += [f'{rounded.format(sql)} AS "{f}_{kind}"' for kind, sql in kinds.items()]
        if last:
            outer.append(f'lag("{f}") OVER ({by_career}) AS "{f}_last"')
    hidden = ", ".join(f'"__td_{f}"' for f in fields)
    return (f"{name} AS (SELECT * EXCLUDE ({hidden}), {', '.join(outer)} FROM "
            f"(SELECT *, {', '.join(inner)} FROM {source}))")
