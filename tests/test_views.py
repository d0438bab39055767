import pytest
from helpers import assert_rows
from pyspark.sql import functions as F

from seasonlens.operators.metrics import bounds
from seasonlens.plans.views import (
    compare_players,
    leader_board,
    leader_boards,
    players,
    players_in_order,
    seasons,
    selected_rows,
    snapshot,
    top_rows,
    weeks,
)

SCHEMA = ("row_id int, season int, week int, player_name string, position string, fantasy_points_ppr double, "
          "predicted_fantasy double, passing_yards double")


@pytest.fixture(scope="module")
def table(spark):
    rows = [(w, 2024, w, "A. Rodgers", "QB", float(w), float(10 - w), None) for w in range(1, 5)]
    rows += [(10 + w, 2024, w, "B. Hall", "RB", float(w) / 3, -1.25, 3.0) for w in range(1, 5)]
    rows += [(20, 2024, 3, "C. Kelce", "TE", None, None, 1.0), (21, 2023, 3, "D. Boswell", "K", 4.0, 99.0, 1.0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_leader_board(table):
    names = lambda *a: [r.player_name for r in leader_board(table, 2024, 3, *a).collect()]
    assert names() == ["A. Rodgers", "B. Hall", "C. Kelce"]
    assert names("FLEX") == ["B. Hall", "C. Kelce"]
    assert names("QB", 8, "Actual") == ["A. Rodgers"]
    assert names("All", "1") == ["A. Rodgers"]
    assert leader_board(table, "2024", "3", order_by="Actual").columns == ["player_name", "fantasy_points_ppr"]
    with pytest.raises(ValueError):
        leader_board(table, 2024, 3, order_by="Best")


def test_top_rows_keep_k_rows_per_task(table):
    plan = top_rows(table, "predicted_fantasy", 2, ["row_id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_compare_players(table):
    out = compare_players(table, "2024", "3", ["A. Rodgers"])
    spliced = [(r.week, r.points) for r in out.where("trace = 'predicted'").collect()]
    actual = [(r.week, r.points) for r in out.where("trace = 'actual'").collect()]
    assert spliced == [(1, 1.0), (2, 2.0), (3, 7.0), (4, 6.0)]
    assert actual == [(1, 1.0), (2, 2.0)]


def test_snapshot(table):
    out = snapshot(table, 2024, ["passing_yards"])
    assert out.count() == 9
    assert_rows(out.where("player_name = 'B. Hall' and week = 1"),
                [{"weeks": "Week 1", "fantasy_points_ppr": 0.3, "predicted_fantasy": -1.2, "passing_yards": 3.0}], ["week"])
    assert out.where("passing_yards is null").count() == 0
    assert [r.row_id for r in top_rows(out, "predicted_fantasy", 32, ["row_id"]).collect()][-1] == 20


def test_selection(table):
    rows = snapshot(table, 2024, ["passing_yards"])
    assert selected_rows(rows, "Week 3").count() == 3
    assert selected_rows(rows, "All", ["A. Rodgers"]).count() == 4
    assert selected_rows(rows.union(rows), "Week 3", ["A. Rodgers"], ["row_id"]).count() == 1
    assert bounds(rows, ["predicted_fantasy", "fantasy_points_ppr"]).first()[0] == -1.2
    assert [r[0] for r in players_in_order(rows, ["row_id"]).collect()] == ["A. Rodgers", "B. Hall", "C. Kelce"]


def test_choices(table):
    assert [r[0] for r in seasons(table, F.col("row_id")).collect()] == [2024, 2023]
    assert [r[0] for r in weeks(table).collect()] == [1, 2, 3, 4]
    assert [r[0] for r in players(table, "K").collect()] == ["C. Kelce"]
    assert players(table).count() == 4


def test_all_boards_are_limited_before_the_shuffle(spark):
    rows = spark.range(200).selectExpr("2000 + id % 2 AS season", "id % 3 AS week", "'QB' AS position", "concat('p', id) AS player_name", "IF(id % 10 = 0, NULL, CAST(id % 50 AS DOUBLE)) AS predicted_fantasy")
    found = leader_boards(rows, 4)
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    groups = {}
    for r in rows.collect():
        groups.setdefault((r.season, r.week), []).append((-(r.predicted_fantasy if r.predicted_fantasy is not None else -1), r.player_name))
    want = {(*key, place, name) for key, players in groups.items() for place, (_, name) in enumerate(sorted(players)[:4], 1)}
    assert {(r.season, r.week, r.place, r.player_name) for r in found.collect()} == want
    with pytest.raises(ValueError):
        leader_boards(rows, 4, "Best")
