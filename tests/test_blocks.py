import random

import pytest
from pyspark.sql import functions as F

from seasonlens.operators import blocks
from seasonlens.operators.exact import Measures
from seasonlens.operators.running import running_total
from helpers import assert_equal_tables


@pytest.mark.parametrize("rows_per_block", [1, 4, 60])
def test_blocks_are_stretches_of_a_group(spark, rows_per_block):
    rnd = random.Random(rows_per_block)
    rows = [(rnd.choice(["hot", "warm", "cold"][: 2 + (i % 9 == 0)]), rnd.randrange(30), i) for i in range(300)]
    rows += [(None, 1, 1000 + i) for i in range(40)]
    df = spark.createDataFrame(rows, "name string, day int, id int")
    hot = blocks.hot_keys(df, ["name"], 30)
    assert {row["name"] for row in hot.collect()} == {"hot", "warm"}
    cold, cut = blocks.split(df, ["name"], ["day", "id"], hot, rows_per_block)
    assert {r["name"] for r in cold.collect()} == {"cold", None}
    got = {r["id"]: r[blocks.BLOCK] for r in cut.collect()}
    for name in ("hot", "warm"):
        numbers = [got[i] for _, i in sorted((day, i) for n, day, i in rows if n == name)]
        assert numbers == sorted(numbers)
        assert rows_per_block == 60 or len(set(numbers)) > 10


def test_partitions_stay_few_when_there_are_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MAX_PARTITIONS", 4)
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'a', 'b') AS name", "id * 7919 % 1000 AS day", "CAST(id % 5 AS DOUBLE) AS x")
    cold, cut = blocks.split(df, ["name"], ["day"], blocks.hot_keys(df, ["name"], 100), 10)
    assert cold.isEmpty() and len(cut.inputFiles()) <= 4
    rows = cut.orderBy("name", "day").collect()
    numbers = [r[blocks.BLOCK] for r in rows]
    assert numbers == sorted(numbers) and len(set(numbers)) >= 100
    assert max(numbers.count(n) for n in set(numbers)) <= 10
    total = running_total(df, ["name"], ["day"], "x", "up_to", rows_per_block=10)
    assert_equal_tables(total, running_total(df, ["name"], ["day"], "x", "up_to"), ["name", "day"])


def test_groups_at_the_limit_are_not_hot(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 6 + [(None,)] * 50, "name string")
    assert [(r["name"], r["__rows"]) for r in blocks.hot_keys(df, ["name"], 5).collect()] == [("b", 6)]
    assert blocks.hot_keys(df, ["name"], 6) is None


def test_sums_do_not_depend_on_the_order(spark):
    rnd = random.Random(4)
    values = [rnd.choice([1e-6, 1, 1e9]) * rnd.uniform(-1, 1) for _ in range(400)] + [None, float("nan")]
    found = set()
    for parts in (1, 3, 11):
        rnd.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        measures = Measures(df, ["x"])
        sums = df.withColumns(measures.columns).agg(*[F.sum(name).alias(name) for name in measures.names])
        row = sums.select(measures.total(0, F.col).alias("total"), measures.mean(0, F.col).alias("mean"), F.col("__k_0")).first()
        found.add(tuple(row))
    assert len(found) == 1
    total, mean, known = found.pop()
    assert known == 400 and mean == total / 400
    assert total == pytest.approx(sum(v for v in values if v is not None and v == v), abs=400 * 2.0**-31)
