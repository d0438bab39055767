from helpers import assert_rows
from pyspark.sql import functions as F

from seasonlens.operators.context import group_totals
from seasonlens.operators.joins import has_hot_key, left_join, null_safe_join, previous_period, replace_names, spread_join, suffix_join
from seasonlens.operators.sets import (
    add_to_selection,
    choices,
    distinct_rows,
    first_seen,
    home_and_away,
    once,
    remove_from_selection,
    union_by_name,
)


def test_previous_week_skips_nothing(spark):
    df = spark.createDataFrame([("X", 1, 5), ("X", 2, 6), ("X", 4, 7)], "name string, week int, pts int")
    out = previous_period(df, ["name"], "week", "pts", "last")
    assert_rows(out, [{"last": None}, {"last": 5}, {"last": None}], ["week"])


def test_namesakes_double_the_match(spark):
    rows = [("X", 1, 5), ("X", 1, 8), ("X", 2, 6), ("X", 2, 9), (None, 1, 3), (None, 2, 4)]
    out = previous_period(spark.createDataFrame(rows, "name string, week int, pts int"), ["name"], "week", "pts", "last")
    found = sorted((r.pts, r["last"]) for r in out.where("week = 2 and name is not null").collect())
    assert found == [(6, 5), (6, 8), (9, 5), (9, 8)]
    assert out.where("name is null and week = 2").first()["last"] == 3


def test_null_keys_join_once(spark):
    a = spark.createDataFrame([(None, 1), ("k", 2)], "key string, x int")
    b = spark.createDataFrame([(None, 10), ("z", 20)], "key string, y int")
    assert null_safe_join(a, b, ["key"]).collect() == [(None, 1, 10)]
    assert_rows(null_safe_join(a, b, ["key"], "left"), [{"x": 1, "y": 10}, {"x": 2, "y": None}], ["x"])


def test_hot_right_keys_change_nothing(spark):
    left = spark.createDataFrame([(None, 1), ("hot", 2), ("cold", 3), ("none", 4), ("hot", 5)], "key string, x int")
    rows = [("hot", i) for i in range(20)] + [("cold", 50), ("cold", 51), (None, 60), ("other", 70)]
    right = spark.createDataFrame(rows, "key string, y int")
    whole = left_join(left, right, ["key"])
    split = left_join(left, right, ["key"], rows=5)
    assert has_hot_key(right, ["key"], 19) and not has_hot_key(right, ["key"], 20)
    assert whole.count() == 44
    assert sorted(whole.collect(), key=str) == sorted(split.select(*whole.columns).collect(), key=str)
    screened = left_join(left, right, ["key"], screen=["key"], rows=5)
    assert screened.count() == 44


def test_hot_lookup_changes_nothing(spark):
    rows = [("X", 1, i) for i in range(12)] + [("X", 2, 99), ("Y", 1, 5), ("Y", 2, 6), (None, 1, 3), (None, 2, 4)]
    df = spark.createDataFrame(rows, "name string, week int, pts int")
    whole = previous_period(df, ["name"], "week", "pts", "last")
    split = previous_period(df, ["name"], "week", "pts", "last", rows=3)
    assert sorted(whole.collect(), key=str) == sorted(split.select(*whole.columns).collect(), key=str)


def test_group_totals(spark):
    rows = [("g", "t", 0, None, 1, True), ("g", "t", 1, 7.0, None, False), ("g", "t", 2, 9.0, 4, True),
            (None, "t", 0, 1.0, 1, True), ("h", "t", 5, None, None, None)]
    df = spark.createDataFrame(rows, "game string, team string, no int, wind double, n int, flag boolean").repartition(3)
    out = group_totals(df, ["game", "team"], sums=["n", "flag"], firsts=["wind"], order=F.col("no"))
    assert_rows(out, [{"game": "g", "wind": 7.0, "n": 5, "flag": 2}, {"game": "h", "wind": None, "n": 0, "flag": 0}],
                ["game"])


def test_suffixes(spark):
    a = spark.createDataFrame([(1, "x", 5)], "id int, home string, n int")
    b = spark.createDataFrame([(1, "y", 6)], "id int, home string, m int")
    out = suffix_join(a, b, ["id"], ("_k", "_def"))
    assert sorted(out.columns) == ["home_def", "home_k", "id", "m", "n"]
    assert_rows(out, [{"home_k": "x", "home_def": "y", "n": 5, "m": 6}], ["id"])


def test_roster_names(spark):
    df = spark.createDataFrame([("1", "old", 10), ("2", "old", 20), ("3", "gone", 30)],
                               "player_id string, player_name string, pts int")
    roster = spark.createDataFrame([("1", "One", 2022), ("1", "One", 2023), ("1", "One", 2024), ("2", "Two", 2023),
                                    ("2", "Too", 2024)], "player_id string, player_name string, season int")
    out = replace_names(df, roster)
    assert sorted((r.player_id, r.player_name) for r in out.collect()) == [("1", "One"), ("2", "Too"), ("2", "Two")]
    # making the roster distinct after the join instead gives the same table
    late = df.drop("player_name").join(roster.select("player_id", "player_name"), "player_id").distinct()
    assert sorted(out.select(*late.columns).collect()) == sorted(late.collect())


def test_home_and_away(spark):
    df = spark.createDataFrame([("g", "H", "A", 3, 7)], "game string, home string, away string, hs int, as_ int")
    out = home_and_away(df, ["game"], {"team": "home", "allowed": "as_"}, {"team": "away", "allowed": "hs"})
    assert sorted(out.collect()) == [("g", "A", 3), ("g", "H", 7)]


def test_sets(spark):
    a = spark.createDataFrame([("p", None), ("p", None), ("q", 1)], "name string, n int")
    assert distinct_rows(a).count() == 2
    stacked = union_by_name(a, spark.createDataFrame([("r", "x")], "name string, extra string"))
    assert stacked.columns == ["name", "n", "extra"] and stacked.count() == 4
    names = a.select("name")
    added = add_to_selection(names, spark.createDataFrame([("q",), ("z",)], "name string"))
    assert [r[0] for r in choices(added, "name").collect()] == ["p", "q", "z"]
    removed = remove_from_selection(added, spark.createDataFrame([("q",), ("w",)], "name string"))
    assert [r[0] for r in choices(removed, "name", descending=True).collect()] == ["z", "p"]
    seen = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a")], "n int, v string")
    assert [r.v for r in first_seen(seen, "v", F.col("n")).collect()] == ["b", "a"]
    assert once(seen, ["v"], F.col("n")).where("v = 'a'").first().n == 2
    assert once(seen, ["v"]).count() == 2


def test_spread_join_deals_a_long_result_to_many_tasks(spark):
    left = spark.range(60).selectExpr("id AS a", "IF(id % 3 = 0, NULL, id % 3) AS g").coalesce(1)
    right = spark.range(30).selectExpr("id AS b", "IF(id % 3 = 0, NULL, id % 3) AS g").coalesce(1)
    got = spread_join(left, right, ["g"], pairs_per_task=100)
    want = [(a, b) for a in range(60) for b in range(30) if a % 3 == b % 3]
    assert sorted((r.a, r.b) for r in got.collect()) == sorted(want)
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert spread_join(left.where("a < 0"), right, ["g"]).isEmpty()
