import random

import pandas as pd
import pytest
from helpers import assert_equal_tables, assert_rows

from seasonlens.operators.running import rank_min, running_total
from seasonlens.plans.defence import points_allowed, points_given_up

ALLOWED = {"A": [10.0, None, 5.0], "B": [10.0, 3.0, 9.0], "C": [7.0, 1.0, 20.0]}
TOTAL = {"A": [10.0, None, 15.0], "B": [10.0, 13.0, 22.0], "C": [7.0, 8.0, 28.0]}
RANK = {"A": [2, None, 1], "B": [2, 2, 2], "C": [1, 1, 3]}


@pytest.mark.parametrize("rows_per_block", [1_000_000, 1, 2])
def test_golden_total_and_rank(spark, rows_per_block):
    rows = [(2024, team, week + 1, value) for team, values in ALLOWED.items() for week, value in enumerate(values)]
    df = spark.createDataFrame(rows[::-1], "season int, team string, week int, x double")
    out = running_total(df, ["season", "team"], ["week"], "x", "total", rows_per_block)
    out = rank_min(out, ["season", "week"], "total", "place", rows_per_block)
    expected = [{"team": t, "total": TOTAL[t][w], "place": RANK[t][w]} for t in "ABC" for w in range(3)]
    assert_rows(out, expected, ["team", "week"])


def data(n=300, seed=2):
    rnd = random.Random(seed)
    return [
        ("hot" if rnd.random() < 0.4 else rnd.choice(["p", "q", None]), i % 37, i,
         None if rnd.random() < 0.2 else float(rnd.randrange(8)))
        for i in range(n)
    ]


@pytest.mark.parametrize("rows_per_block", [1_000_000, 4, 20])
def test_total_matches_pandas(spark, rows_per_block):
    rows = data()
    pdf = pd.DataFrame(rows, columns=["team", "day", "id", "x"]).sort_values(["day", "id"])
    pdf["total"] = pdf.groupby("team")["x"].cumsum()
    df = spark.createDataFrame(rows, "team string, day int, id int, x double")
    out = running_total(df, ["team"], ["day", "id"], "x", "total", rows_per_block)
    expected = pdf.sort_values("id")[["id", "total"]].to_dict("records")
    assert_rows(out, [{k: None if pd.isna(v) else v for k, v in row.items()} for row in expected], ["id"])


def test_blocks_change_no_bit_of_a_total(spark):
    rnd = random.Random(12)
    rows = [("hot", i, rnd.choice([1e-5, 1.0, 1e8]) * rnd.uniform(-1, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "team string, id int, x double")

    def totals(rows_per_block, parts):
        out = running_total(df.repartition(parts), ["team"], ["id"], "x", "total", rows_per_block)
        return {r.id: r.total.hex() for r in out.collect()}

    whole = totals(1_000_000, 4)
    assert all(totals(n, parts) == whole for n, parts in ((1, 4), (7, 3), (20, 5)))


@pytest.mark.parametrize("rows_per_block", [1_000_000, 4, 20])
def test_rank_matches_pandas(spark, rows_per_block):
    rows = data(seed=8)
    pdf = pd.DataFrame(rows, columns=["team", "day", "id", "x"])
    pdf["place"] = pdf.groupby("team")["x"].rank(method="min", ascending=True)
    df = spark.createDataFrame(rows, "team string, day int, id int, x double")
    out = rank_min(df, ["team"], "x", "place", rows_per_block)
    expected = [{"id": r["id"], "place": None if pd.isna(r["place"]) else int(r["place"])}
                for r in pdf.to_dict("records")]
    assert_rows(out, expected, ["id"])


def test_points_allowed_and_given_up(spark):
    games = [("g1", 2024, 1, "A", "B", 20.0, 10.0), ("g2", 2024, 2, "B", "A", 7.0, 3.0),
             ("g3", 2024, 3, "A", "B", None, None)]
    schedules = spark.createDataFrame(
        games, "game_id string, season int, week int, home_team string, away_team string, home_score double, "
        "away_score double")
    allowed = points_allowed(schedules)
    assert_rows(allowed, [
        {"opponent_team": "A", "points_allowed": 10.0, "cumulative_points_allowed": 10.0, "defensive_rank": 1},
        {"opponent_team": "A", "points_allowed": 7.0, "cumulative_points_allowed": 17.0, "defensive_rank": 1},
        {"opponent_team": "A", "points_allowed": None, "cumulative_points_allowed": None, "defensive_rank": None},
        {"opponent_team": "B", "points_allowed": 20.0, "cumulative_points_allowed": 20.0, "defensive_rank": 2},
        {"opponent_team": "B", "points_allowed": 3.0, "cumulative_points_allowed": 23.0, "defensive_rank": 2},
        {"opponent_team": "B", "points_allowed": None, "cumulative_points_allowed": None, "defensive_rank": None},
    ], ["opponent_team", "week"])
    players = spark.createDataFrame(
        [(1, 2024, "A", "RB", 9.0), (1, 2024, "A", "WR", 4.0)],
        "week int, season int, opponent_team string, position string, fantasy_points_ppr double")
    out = points_given_up(allowed, players)
    assert out.count() == 7
    assert sorted(r.prior_allowed_fp for r in out.where("week_of_interest = 1 and opponent_team = 'A'").collect()) == [4, 9]
    assert {(r.week_of_interest, r.week) for r in out.collect()} == {(1, 2), (2, 3), (3, 4)}
    assert_equal_tables(points_allowed(schedules, rows_per_block=1), allowed, ["opponent_team", "week"])
