import pytest
from helpers import assert_equal_tables
from league import league_frames, make_league
from pyspark.sql import functions as F

from seasonlens.schemas import SOURCES, require_columns
from seasonlens.plans.features import team_context
from seasonlens.session import release, stage, staging_dir
from seasonlens.sources.readers import load_seasons, read_csv, read_season_table
from seasonlens.sources.writers import export_csv, replace_seasons, write_csv, write_seasons


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("seasons")
    for name, df in league_frames(spark, make_league()).items():
        write_seasons(df, f"{path}/{name}")
    return str(path)


def test_load_a_range_of_seasons(spark, folder):
    everything = load_seasons(spark, folder)
    some = load_seasons(spark, folder, 2014, 2015)
    for name in SOURCES:
        table = getattr(some, name)
        assert set(table.columns) == set(SOURCES[name].names)
        assert {r[0] for r in table.select("season").distinct().collect()} == {2014, 2015}
        assert table.count() == getattr(everything, name).where("season >= 2014").count() > 0


def test_season_range_prunes_files_and_columns(spark, folder):
    table = load_seasons(spark, folder, 2015, 2015).pbp
    assert all("season=2015" in row[0] for row in table.select(F.input_file_name()).distinct().collect())
    plan = table.select("game_id", "wind")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    assert "ReadSchema: struct<game_id:string,wind:double>" in plan


def test_seasons_are_few_files_and_long_ones_are_cut(spark, tmp_path):
    df = spark.range(200_000).select((F.when(F.col("id") % 10 == 0, 2023).otherwise(2024)).alias("season"),
                                     F.rand(1).alias("x")).repartition(12)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    try:
        write_seasons(df, f"{tmp_path}/rows")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {s: len(list((tmp_path / "rows" / f"season={s}").glob("*.parquet"))) for s in (2023, 2024)}
    assert files[2023] < 12 and 1 < files[2024] < 12
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 200_000


def test_a_missing_column_is_an_error(spark, folder, tmp_path):
    plays = spark.read.parquet(f"{folder}/pbp")
    write_seasons(plays.drop("play_id"), f"{tmp_path}/pbp")
    with pytest.raises(ValueError, match="pbp: missing columns: play_id"):
        read_season_table(spark, str(tmp_path), "pbp", 1999, 2024)
    write_seasons(plays.drop("play_id", "wind"), f"{tmp_path}/two/pbp")
    with pytest.raises(ValueError, match="missing columns: wind, play_id"):
        read_season_table(spark, f"{tmp_path}/two", "pbp", 1999, 2024)


def test_another_type_is_an_error(spark, folder, tmp_path):
    plays = spark.read.parquet(f"{folder}/pbp")
    write_seasons(plays.withColumn("wind", F.col("wind").cast("string")), f"{tmp_path}/pbp")
    with pytest.raises(ValueError, match="pbp: column wind is string, not double"):
        read_season_table(spark, str(tmp_path), "pbp", 1999, 2024)


def test_another_order_column(spark, folder, tmp_path):
    plays = spark.read.parquet(f"{folder}/pbp")
    write_seasons(plays.withColumn("sequence", F.col("play_id").cast("double")).drop("play_id"), f"{tmp_path}/pbp")
    table = read_season_table(spark, str(tmp_path), "pbp", 1999, 2024, play_order="sequence")
    assert dict(table.dtypes)["play_id"] == "bigint"
    same = team_context(read_season_table(spark, folder, "pbp", 1999, 2024))
    assert_equal_tables(team_context(table), same, ["game_id", "team"])
    assert same.where("wind is not null and roof is not null").count() > 0


def test_a_play_without_order_is_an_error(spark, folder, tmp_path):
    plays = spark.read.parquet(f"{folder}/pbp")
    write_seasons(plays.withColumn("play_id", F.when(F.col("play_id") > 1, F.col("play_id"))), f"{tmp_path}/pbp")
    table = read_season_table(spark, str(tmp_path), "pbp", 1999, 2024)
    with pytest.raises(Exception, match="a play has no play_id"):
        team_context(table).collect()


def test_staged_tables_are_removed(spark):
    from pathlib import Path

    path = stage(spark.range(3), "gone").inputFiles()[0].removeprefix("file:")
    assert Path(path).exists()
    release(spark)
    assert not Path(path).exists()


def test_nan_is_read_as_null(spark, tmp_path):
    df = spark.createDataFrame([("g", 2024, 1, "a", "b", float("nan"), 3.0)], SOURCES["schedules"])
    write_seasons(df, f"{tmp_path}/schedules")
    rows = spark.read.parquet(f"{tmp_path}/schedules")
    assert rows.where(F.isnan("home_score")).count() == 1
    assert read_season_table(spark, str(tmp_path), "schedules", 2024, 2024).first().home_score is None


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A, Jr", 1, 2.5), ("B", 2, None)], "name string, week int, pts double")
    write_csv(df, f"{tmp_path}/plain")
    assert_equal_tables(read_csv(spark, f"{tmp_path}/plain", df.schema), df, ["week"])
    assert dict(read_csv(spark, f"{tmp_path}/plain").dtypes) == {"name": "string", "week": "int", "pts": "double"}
    export_csv(df, f"{tmp_path}/export")
    assert read_csv(spark, f"{tmp_path}/export").orderBy("week").first().name == "A- Jr"


def test_stray_index_column_is_dropped(spark, tmp_path):
    for header in (",name,week", "Unnamed: 0,name,week"):
        path = tmp_path / f"{len(header)}.csv"
        path.write_text(f"{header}\n0,a,1\n1,b,2\n")
        assert read_csv(spark, str(path)).columns == ["name", "week"]


def test_required_columns(spark):
    df = spark.range(1)
    assert require_columns(df, "id") is df
    with pytest.raises(ValueError, match="posteam, defteam"):
        require_columns(df, "posteam", "id", "defteam")


def test_staged_tables_live_in_the_shared_folder(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    staged = stage(df, "numbers")
    assert_equal_tables(staged, df, ["id"])
    shared = staging_dir(spark)
    assert shared == spark.conf.get("spark.checkpoint.dir")
    assert all(shared in path for path in staged.inputFiles())


def test_replace_single_seasons(spark, tmp_path):
    path = f"{tmp_path}/seasons"
    rows = spark.range(300).selectExpr("id", "CAST(2000 + id % 3 AS INT) AS season", "id % 7 AS week", "0 AS v")
    write_seasons(rows, path, order=["week"])
    for _ in range(2):  # a rerun gives the same table
        replace_seasons(rows.where("season = 2001 AND id < 100").unionByName(rows.limit(5).selectExpr("id", "2009 AS season", "week", "v")).selectExpr("id", "season", "week", "1 AS v"), path)
        found = {(r.season, r.v): r["count"] for r in spark.read.parquet(path).groupBy("season", "v").count().collect()}
        assert found == {(2000, 0): 100, (2001, 1): 33, (2002, 0): 100, (2009, 1): 5}
    replace_seasons(rows.where("false"), path)
    assert spark.read.parquet(path).count() == 238
