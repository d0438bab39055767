"""History features against golden rows, a pandas version, and the blocked path."""

import random

import pandas as pd
import pytest
from helpers import assert_equal_tables, assert_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seasonlens.operators.history import feature_names, player_history, side_history

SCHEMA = "player string, season int, day int, id int, x double, y int"
ORDER = ["day", "id"]

GOLDEN = [
    # season, value, n_career, n_season, mean_career, mean_season, mean_last5, last
    (2022, 10.0, 1, 1, None, None, None, None),
    (2022, 20.0, 2, 2, 10.0, 10.0, 10.0, 10.0),
    (2022, None, 3, 3, 15.0, 15.0, 15.0, 20.0),
    (2023, 40.0, 4, 1, 15.0, 15.0, 15.0, None),
    (2023, 0.0, 5, 2, 70 / 3, 40.0, 70 / 3, 40.0),
    (2023, 5.0, 6, 3, 17.5, 20.0, 17.5, 0.0),
    (2023, 9.0, 7, 4, 15.0, 15.0, 16.25, 5.0),
]


def golden_input(spark):
    rows = [("a", g[0], i, i, g[1], i) for i, g in enumerate(GOLDEN)]
    rows += [("b", 2022 + i % 2, i, 50 + i, float(i), i) for i in range(4)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def golden_rows(base):
    return [
        {"n_games_career": g[2] + base - 1, "n_games_season": g[3] + base - 1, "x_mean_career": g[4],
         "x_mean_season": g[5], "x_mean_last5": g[6], **({"x_last": g[7]} if base else {})}
        for g in GOLDEN
    ]


@pytest.mark.parametrize("rows_per_block", [1_000_000, 1, 2, 3])
def test_golden(spark, rows_per_block):
    df = golden_input(spark)
    out = player_history(df, ["player"], "season", ORDER, ["x"], rows_per_block=rows_per_block)
    assert_rows(out.where("player = 'a'"), golden_rows(1), ["day"])
    out = side_history(df, ["player"], "season", ORDER, ["x"], rows_per_block=rows_per_block)
    assert "x_last" not in out.columns
    assert_rows(out.where("player = 'a'"), golden_rows(0), ["day"])


def random_rows(seed, n=400, hot=0.34):
    rnd = random.Random(seed)
    return [
        (
            "hot" if rnd.random() < hot else f"p{rnd.randrange(25)}",
            rnd.randrange(2019, 2024),
            rnd.randrange(40),
            i,
            None if rnd.random() < 0.2 else float(rnd.randrange(100)),
            None if rnd.random() < 0.2 else rnd.randrange(50),
        )
        for i in range(n)
    ]


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def by_loop(rows, career):
    """For each row, the rows before it in a list."""
    out = []
    for row in sorted(rows, key=lambda r: r[3]):
        player, season, day, number = row[:4]
        own = sorted((r for r in rows if r[0] == player), key=lambda r: r[1:4])
        at = own.index(row)
        earlier = own[:at]
        last_season = [r for r in earlier if r[1] == earlier[-1][1]] if earlier else []
        found = {"id": number, "n_games_career": at + 1, "n_games_season": 1 + sum(r[1] == season for r in earlier)}
        for field, place in (("x", 4), ("y", 5)):
            if career:
                found[f"{field}_mean_career"] = mean(r[place] for r in earlier)
            found[f"{field}_mean_season"] = mean(r[place] for r in last_season)
            found[f"{field}_mean_last5"] = mean(r[place] for r in earlier[-5:])
            found[f"{field}_last"] = earlier[-1][place] if earlier else None
        out.append(found)
    return out


@pytest.mark.parametrize("rows_per_block", [1_000_000, 7, 60])
@pytest.mark.parametrize("career", [True, False])
def test_matches_a_plain_loop(spark, rows_per_block, career):
    rows = random_rows(5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = player_history(df, ["player"], "season", ORDER, ["x", "y"], career=career, rows_per_block=rows_per_block)
    assert_rows(out, by_loop(rows, career), ["id"])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(2020, 2022), st.integers(0, 3),
                  st.one_of(st.none(), st.integers(0, 9))),
        min_size=1, max_size=25,
    ),
    rows_per_block=st.integers(1, 9),
)
def test_blocks_change_nothing(spark, rows, rows_per_block):
    data = [(p, s, d, i, None if v is None else float(v), v) for i, (p, s, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    whole = player_history(df, ["player"], "season", ORDER, ["x", "y"])
    split = player_history(df, ["player"], "season", ORDER, ["x", "y"], rows_per_block=rows_per_block)
    assert_equal_tables(split, whole, ["id"])


def test_grouped_pandas_function_agrees(spark):
    """The same features by a Python function per entity, as an independent check."""
    df = spark.createDataFrame(random_rows(11, n=150), SCHEMA)

    def per_entity(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["season", "day", "id"])
        to_date = pdf.groupby("season")["x"].transform(lambda s: s.expanding().mean())
        return pd.DataFrame({"id": pdf["id"], "season_mean": to_date.shift(),
                             "recent": pdf["x"].rolling(5, min_periods=1).mean().shift()})

    grouped = df.groupBy("player").applyInPandas(per_entity, "id int, season_mean double, recent double")
    ours = player_history(df, ["player"], "season", ORDER, ["x"]).select(
        "id", F.col("x_mean_season").alias("season_mean"), F.col("x_mean_last5").alias("recent"))
    assert_equal_tables(ours, grouped.select(*[F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) if c != "id"
                                               else F.col(c) for c in grouped.columns]), ["id"])


@pytest.mark.parametrize("rows_per_block", [1_000_000, 10])
def test_no_leakage(spark, rows_per_block):
    rows = random_rows(3, n=120)
    changed = [(*r[:4], 9999.0 if (r[1], r[2], r[3]) >= (2021, 20, 0) else r[4], r[5]) for r in rows]
    before = lambda df: df.where("season < 2021 or (season = 2021 and day < 20)").select(
        "id", *feature_names(["x"]))
    a, b = (
        before(player_history(spark.createDataFrame(data, SCHEMA), ["player"], "season", ORDER, ["x"],
                              rows_per_block=rows_per_block))
        for data in (rows, changed)
    )
    assert_equal_tables(a, b, ["id"])


@pytest.mark.parametrize("rows_per_block", [1_000_000, 10])
def test_rows_without_an_entity_are_kept(spark, rows_per_block):
    rows = random_rows(4, n=80) + [(None, 2020, d, 1000 + d, 1.0, 1) for d in range(30)]
    out = player_history(spark.createDataFrame(rows, SCHEMA), ["player"], "season", ORDER, ["x"],
                         rows_per_block=rows_per_block)
    assert out.count() == 110
    unknown = out.where("player is null")
    assert unknown.count() == 30
    assert unknown.dropna(how="all", subset=["n_games_career", *feature_names(["x"])]).count() == 0


def uneven(seed, n=400):
    """Doubles of mixed size, whose sum depends on the order in which doubles are added."""
    rnd = random.Random(seed)
    return [(*row[:4], None if rnd.random() < 0.1 else rnd.choice([1e-5, 1.0, 1e8]) * rnd.uniform(-1, 1), row[5])
            for row in random_rows(seed, n)]


def exact_rows(df):
    """Rows with the very bits of doubles."""
    return sorted(tuple(v.hex() if isinstance(v, float) else v for v in row) for row in df.collect())


def test_blocks_change_no_bit(spark):
    df = spark.createDataFrame([("one", *row[1:]) for row in uneven(9)], SCHEMA)
    names = ["id", "n_games_career", "n_games_season", *feature_names(["x", "y"])]
    whole = exact_rows(player_history(df, ["player"], "season", ORDER, ["x", "y"]).select(*names))
    for rows_per_block, parts in ((1, 4), (7, 4), (20, 4), (20, 3)):
        split = player_history(df.repartition(parts), ["player"], "season", ORDER, ["x", "y"], rows_per_block=rows_per_block)
        assert exact_rows(split.select(*names)) == whole, rows_per_block


def test_one_shuffle_and_one_sort(spark):
    """Both window levels run on a single exchange, in a single order."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = golden_input(spark)
        plan = player_history(df, ["player"], "season", ORDER, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_only_the_given_columns_are_shuffled_and_sorted(spark):
    df = spark.createDataFrame([("a", 1, 1, 0.5)], "name string, season int, day int, x double")
    plan = player_history(df, ["name"], "season", ["day"], ["x"])._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Sort ["):]
    assert "RepartitionByExpression" in below and "__w_0" in plan and "__w_0" not in below
