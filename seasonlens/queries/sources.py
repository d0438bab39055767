"""Round trips through the sources and sinks: what is read back must be what SQL gives for the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonlens.queries.registry import query
from seasonlens.queries.roles import GAMES, SCHEDULES, games, schedules, table, with_sql
from seasonlens.session import scratch
from seasonlens.sources.readers import read_csv, read_season_table
from seasonlens.sources.writers import export_csv, replace_seasons, write_csv, write_seasons


@query("s_load_seasons", with_sql(SCHEDULES, "SELECT * FROM schedules WHERE season BETWEEN 1994 AND 1996"))
def s_load_seasons(spark, sf_dir):
    """All games written by season, three seasons read back."""
    folder = scratch(spark, "seasons")
    write_seasons(schedules(spark, sf_dir), f"{folder}/schedules")
    return read_season_table(spark, folder, "schedules", 1994, 1996)


@query("s_write_seasons", with_sql(GAMES, "SELECT season, count(*) AS n, CAST(sum(pts) AS BIGINT) AS pts FROM games GROUP BY season"))
def s_write_seasons(spark, sf_dir):
    """Every season of a partitioned table, counted from its files."""
    folder = scratch(spark, "predictions")
    write_seasons(games(spark, sf_dir).select("game_id", "season", "pts"), folder)
    return spark.read.parquet(folder).groupBy("season").agg(F.count("game_id").alias("n"), F.sum("pts").alias("pts"))


@query(
    "s_replace_season",
    with_sql(GAMES, """SELECT season, count(*) AS n, CAST(sum(CASE WHEN season = 1996 THEN 2 * pts ELSE pts END) AS BIGINT) AS pts
                       FROM games GROUP BY season"""),
)
def s_replace_season(spark, sf_dir):
    """One season is written anew with other points; the rest of the table stays."""
    folder = scratch(spark, "predictions")
    rows = games(spark, sf_dir).select("game_id", "season", "week", "pts")
    write_seasons(rows, folder, order=["week"])
    replace_seasons(rows.where("season = 1996").withColumn("pts", 2 * F.col("pts")), folder, order=["week"])
    return spark.read.parquet(folder).groupBy("season").agg(F.count("game_id").alias("n"), F.sum("pts").alias("pts"))


CUSTOMERS = "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer"


@query("s_csv", CUSTOMERS)
def s_csv(spark, sf_dir):
    """A table written as CSV and read back with its schema."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = scratch(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@query("s_csv_index", CUSTOMERS)
def s_csv_index(spark, sf_dir):
    """The same with a stray index column in front, which the reader drops."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = scratch(spark, "csv-index")
    numbered = rows.select(F.col("c_custkey").alias("Unnamed: 0"), "*")
    write_csv(numbered, path)
    return read_csv(spark, path, numbered.schema)


@query("s_export", "SELECT p_partkey, replace(p_name || ', ' || p_brand, ',', '-') AS label FROM part")
def s_export(spark, sf_dir):
    """An export, in which commas are dashes, read back."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(", ", "p_name", "p_brand").alias("label"))
    path = scratch(spark, "export")
    export_csv(rows, path)
    return read_csv(spark, path, rows.schema)
