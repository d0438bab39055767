import pytest
from helpers import assert_rows
from pyspark.sql import functions as F

from seasonlens.functions.encode import align, fit_indicators, level_index, sparse_indicators
from seasonlens.functions.exprs import (
    contains_text,
    drop_range,
    fill_nulls,
    half_even,
    kick_flags,
    plain_text,
    position_filter,
    quality_counts,
    round_numbers,
    swap_where,
    to_date_or_null,
    week_label,
)
from seasonlens.plans.features import kicks

KICK_SCHEMA = ("id int, play_type string, extra_point_result string, field_goal_result string, kick_distance double, "
               "game_date string, posteam string, defteam string, kicker_player_name string")
KICK_CASES = [
    # play_type, xp result, fg result, distance, date, flags that are set
    ("field_goal", None, "made", 39.0, "2014-10-01", {"0-39_fg_made"}),
    ("field_goal", None, "made", 40.0, "2014-10-01", {"40-49_fg_made"}),
    ("field_goal", None, "missed", 49.0, "2016-10-01", {"missed_fg_40-49"}),
    ("field_goal", None, "missed", 50.0, "2016-10-01", {"missed_fg_50+"}),
    ("field_goal", None, "blocked", 45.0, "2016-10-01", set()),
    ("field_goal", None, "made", None, "2016-10-01", set()),
    ("extra_point", "good", None, 33.0, "2014-12-31", {"xp_attempt_19y", "xp_made_19y"}),
    ("extra_point", "failed", None, 33.0, "2015-01-01", {"xp_attempt_33y"}),
    ("extra_point", "good", None, 33.0, "bad", {"xp_attempt_33y", "xp_made_33y"}),
    ("kickoff", None, None, 65.0, "2016-10-01", set()),
]


def test_kick_flags(spark):
    rows = [(i, *case[:5], "OFF", "DEF", "kicker") for i, case in enumerate(KICK_CASES)]
    rows += [(90, "pass", None, None, None, "2016-10-01", "OFF", "DEF", "kicker"),
             (91, "kickoff", None, None, None, "2016-10-01", "OFF", "DEF", None)]
    out = kicks(spark.createDataFrame(rows, KICK_SCHEMA)).orderBy("id").collect()
    assert [row.id for row in out] == list(range(len(KICK_CASES)))
    names = list(kick_flags(*[F.lit(None)] * 4))
    assert len(names) == 10
    for row, case in zip(out, KICK_CASES):
        assert {name for name in names if row[name]} == case[5]
        assert all(row[name] is not None for name in names)
        made = sum(name.endswith("_fg_made") for name in case[5])
        missed = sum(name.startswith("missed_fg") for name in case[5])
        assert (row.total_fg_made, row.total_fg_missed) == (made, missed)
        assert (row.posteam, row.defteam) == (("DEF", "OFF") if case[0] == "kickoff" else ("OFF", "DEF"))


def test_kicks_need_their_columns(spark):
    with pytest.raises(ValueError, match="defteam"):
        kicks(spark.createDataFrame([(1, "x")], "game_id int, posteam string"))


def test_rounding_is_half_even_on_the_double(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.675,), (1.005,), (-0.125,)], "x double")
    got = [row[0] for row in df.select(half_even("x", 2)).collect()]
    assert got == [0.12, 0.14, 2.68, 1.0, -0.12]
    mixed = spark.createDataFrame([(1.26, 7)], "x double, n int")
    assert round_numbers(mixed, 1).collect() == [(1.3, 7)]


def test_fill_nulls(spark):
    df = spark.createDataFrame([(None, None, None, None)], "x double, n int, s string, b boolean")
    assert fill_nulls(df).collect() == [(0.0, 0, "0", None)]
    assert fill_nulls(df, ["x"]).collect() == [(0.0, None, None, None)]


def test_swap_twice_is_identity(spark):
    df = spark.createDataFrame([(1, "a", "b"), (None, "c", "d"), (2, "e", None)], "n int, x string, y string")
    once = swap_where(df, F.col("n") >= 1, "x", "y")
    assert once.collect() == [(1, "b", "a"), (None, "c", "d"), (2, None, "e")]
    assert swap_where(once, F.col("n") >= 1, "x", "y").collect() == df.collect()


def test_dates(spark):
    df = spark.createDataFrame([("2014-10-01",), ("bad",), (None,), ("2014-02-30",)], "d string")
    parsed = [row[0] for row in df.select(to_date_or_null("d")).collect()]
    assert [str(d) for d in parsed] == ["2014-10-01", "None", "None", "None"]
    counts = quality_counts(df, F.col("d") == "bad", "d").first()
    assert tuple(counts) == (1, 2, True)


def test_text(spark):
    df = spark.createDataFrame([(3, "A.Rodgers, Jr"), (10, "B.Favre")], "week int, name string")
    assert [r[0] for r in df.select(week_label()).collect()] == ["Week 3", "Week 10"]
    assert df.where(contains_text("name", "RODG")).count() == 1
    assert plain_text(df).collect() == [("3", "A.Rodgers- Jr"), ("10", "B.Favre")]


def test_positions(spark):
    df = spark.createDataFrame([(p,) for p in ["QB", "RB", "WR", "TE", "FB", "K"]], "position string")
    kept = lambda code: {r[0] for r in df.where(position_filter(code)).collect()}
    assert kept("All") == {"QB", "RB", "WR", "TE", "FB", "K"}
    assert kept("FLEX") == {"RB", "WR", "TE", "FB"}
    assert kept("K") == {"K"}


def test_drop_range(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert drop_range(df, "b", "c").columns == ["a", "d"]


def test_indicators(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "a"), (5, None), (6, "it's")], "id int, x string")
    fitted = fit_indicators(df, ["id", "x"])
    assert_rows(fitted.transform(df),
                [{"id": i + 1, "x_b": b, "x_c": c, "x_it's": q}
                 for i, (b, c, q) in enumerate([(1, 0, 0), (0, 0, 0), (0, 1, 0), (0, 0, 0), (0, 0, 0), (0, 0, 1)])], ["id"])
    unseen = spark.createDataFrame([(7, "z")], "id int, x string")
    assert_rows(fitted.transform(unseen), [{"x_b": 0, "x_c": 0}], ["id"])
    numbers = spark.createDataFrame([(1, True)], "id int, flag boolean")
    assert fit_indicators(numbers, ["id", "flag"]).transform(numbers).columns == ["id", "flag"]
    with pytest.raises(ValueError, match="levels"):
        fit_indicators(df, ["x"], max_levels=2)
    assert align(df.select("id"), ["x_b", "id"]).first() == (0, 1)


def test_indicators_of_any_number_of_levels(spark):
    rows = spark.range(100_000).selectExpr("id", "concat('v', lpad(id, 6, '0')) AS kind").repartition(5)
    levels = level_index(rows, "kind")
    assert levels.where("at <> CAST(substr(level, 2) AS INT)").isEmpty() and levels.count() == 100_000
    new = spark.createDataFrame([(1, "v000000"), (2, "v000001"), (3, "v099999"), (4, "other"), (5, None)], "id int, kind string")
    found = {r.id: r.made for r in sparse_indicators(new, "kind", levels, "made").collect()}
    assert {i: (v.size, v.indices.tolist()) for i, v in found.items()} == {
        1: (99_999, []), 2: (99_999, [0]), 3: (99_999, [99_998]), 4: (99_999, []), 5: (99_999, [])}


def test_indicators_without_levels(spark):
    rows = spark.createDataFrame([(1, None)], "id int, kind string")
    found = sparse_indicators(rows, "kind", level_index(rows, "kind"), "made").first().made
    assert found.size == 0
