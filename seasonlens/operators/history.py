"""History features: what was known about an entity before each of its rows.

Rows are ordered by (season, *order) within an entity. Means skip nulls and never see the
current row. The season mean is that of the row before, so the first row of a season shows the
final mean of the last season played.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonlens.operators.blocks import BLOCK, LANE, ROWS_PER_BLOCK, hot_keys, lane, split
from seasonlens.operators.exact import Measures
from seasonlens.session import stage

LAST_ROWS = 5


def feature_names(fields: list[str], career: bool = True, last: bool = True) -> list[str]:
    """Names of the per-field features, in output order."""
    kinds = [*(["mean_career"] if career else []), "mean_season", "mean_last5", *(["last"] if last else [])]
    return [f"{field}_{kind}" for field in fields for kind in kinds]


def player_history(df: DataFrame, entity: list[str], season: str, order: list[str], fields: list[str],
                   career: bool = True, **skew) -> DataFrame:
    """Counters from 1 (current row included), means and previous value."""
    return history_features(df, entity, season, order, fields, career=career, base=1, last=True,
                            career_counter=True, **skew)


def side_history(df: DataFrame, entity: list[str], season: str, order: list[str], fields: list[str],
                 career: bool = True, **skew) -> DataFrame:
    """Counters of earlier rows (from 0) and means; the career counter only with ``career``."""
    return history_features(df, entity, season, order, fields, career=career, base=0, last=False,
                            career_counter=career, **skew)


def history_features(
    df: DataFrame,
    entity: list[str],
    season: str,
    order: list[str],
    fields: list[str],
    *,
    career: bool = True,
    base: int = 1,
    last: bool = True,
    career_counter: bool = True,
    rows_per_block: int = ROWS_PER_BLOCK,
    stage_first: bool = False,
) -> DataFrame:
    """Add ``n_games_career``, ``n_games_season`` and the features of ``feature_names`` to ``df``.

    ``(season, *order)`` must be unique within an entity and ``season`` not null. Rows without
    an entity keep null features. Entities are counted when this is called; those above
    ``rows_per_block`` rows are computed in blocks, with the same results to the last bit. With
    ``stage_first`` ``df`` is written once first, which pays when it is itself the result of joins.
    """
    names = feature_names(fields, career, last)
    out = [F.col(name) for name in df.columns]
    counters = [*(["n_games_career"] if career_counter else []), "n_games_season"]
    keep = [*out, *[F.col(name) for name in [*counters, *names]]]

    if stage_first:
        df = stage(df, "history")
    hot = hot_keys(df, entity, rows_per_block)
    if hot is None:
        return _whole(df, entity, season, order, fields, base).select(*keep)
    cold, blocks = split(df, entity, [season, *order], hot, rows_per_block)
    whole = _whole(cold, entity, season, order, fields, base).select(*keep)
    return whole.unionByName(_blocked(blocks, entity, season, order, fields, base).select(*keep))


def _whole(df: DataFrame, entity: list[str], season: str, order: list[str], fields: list[str], base: int) -> DataFrame:
    group = [*entity, LANE]
    by, within = ", ".join(map(quoted, group)), ", ".join(map(quoted, order))
    in_season = f"PARTITION BY {by}, {quoted(season)} ORDER BY {within}"
    in_career = f"PARTITION BY {by} ORDER BY {quoted(season)}, {within}"
    to_date = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

    measures = Measures(df, fields)
    place = {name: at for at, name in enumerate(measures.names)}
    # hash(entity) also clusters (entity, season), and all windows share one sort; both move the given columns only
    rows = df.withColumn(LANE, lane(df, entity)).repartition(*group).sortWithinPartitions(*group, season, *order)
    rows = rows.withColumns(measures.columns)
    # the state of a row: all running totals in one array. Everything else is a difference of two states.
    totals = ", ".join(f"sum({name}) OVER ({in_career} {to_date})" for name in measures.names)
    rows = rows.selectExpr(
        "*",
        f"row_number() OVER ({in_career}) AS __career_row",
        f"row_number() OVER ({in_season}) AS __season_row",
        f"array({totals}) AS __totals",
    ).drop(*measures.names)
    rows = rows.selectExpr(
        "*",
        f"lag(__totals) OVER ({in_career}) AS __before",
        f"lag(__totals, {LAST_ROWS + 1}) OVER ({in_career}) AS __older",
        *[f"lag({quoted(field)}) OVER ({in_career}) AS {quoted(f'{field}_last')}" for field in fields],
    )
    # what came before the season of the row before
    rows = rows.selectExpr("*", f"first(__before) OVER ({in_season} {to_date}) AS __opening")
    rows = rows.selectExpr("*", f"lag(__opening) OVER ({in_career}) AS __start")

    def since(earlier: str) -> Callable[[str], str]:
        return lambda name: f"(__before[{place[name]}] - coalesce({earlier}[{place[name]}], 0L))"

    # rows without an entity have no history
    known = " AND ".join(f"{quoted(key)} IS NOT NULL" for key in entity)
    made = {"n_games_career": f"CAST(__career_row + {base - 1} AS LONG)", "n_games_season": f"CAST(__season_row + {base - 1} AS LONG)"}
    for at, field in enumerate(fields):
        made[f"{field}_mean_career"] = measures.mean_sql(at, lambda name: f"__before[{place[name]}]")
        made[f"{field}_mean_season"] = measures.mean_sql(at, since("__start"))
        made[f"{field}_mean_last5"] = measures.mean_sql(at, since("__older"))
        made[f"{field}_last"] = quoted(f"{field}_last")
    features = [f"CASE WHEN {known} THEN {sql} END AS {quoted(name)}" for name, sql in made.items()]
    return rows.selectExpr(*[quoted(name) for name in df.columns if name not in made], *features)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _blocked(df: DataFrame, entity: list[str], season: str, order: list[str], fields: list[str], base: int) -> DataFrame:
    """The same for rows with a block: what a row sees in its block, and what earlier blocks add up to."""
    part = [*entity, BLOCK]
    measures = Measures(df, fields)
    df = df.withColumns(measures.columns)
    rows = _within_blocks(df, part, season, order, fields, measures)
    rows = rows.join(_carried(df, entity, season, order, fields, measures), part, "left")

    zero = F.lit(0).cast("long")
    first = F.col("__row") == 1
    # the season that was running when the block began, its rows and totals so far
    open_season = F.col("__end")["season"]
    same = F.coalesce(F.col(season) == open_season, F.lit(False))
    reaches_back = first | F.coalesce(F.col("__prev_season") == open_season, F.lit(False))
    borrowed = F.greatest(F.lit(0), F.lit(LAST_ROWS + 1) - F.col("__row"))
    tail = F.col("__tail_rows")
    lent = F.when(borrowed > 0, F.reverse(F.slice(F.reverse(tail), 1, borrowed)))

    def career(name):
        return F.coalesce(f"__sum{name}", zero) + F.coalesce(f"__prior{name}", zero)

    def in_season(name):
        carried = F.when(reaches_back, F.coalesce(F.col("__end")[name], zero)).otherwise(zero)
        return F.coalesce(f"__prev_season{name}", zero) + carried

    def recent(name):
        values = lent.getField(name)
        return F.coalesce(f"__recent{name}", zero) + F.coalesce(F.aggregate(values, zero, lambda a, b: a + b), zero)

    out = {
        "n_games_career": (F.col("__row") + F.coalesce("__prior_rows", F.lit(0)) + (base - 1)).cast("long"),
        "n_games_season": (
            F.col("__season_row") + F.when(same, F.col("__end")["rows"]).otherwise(0) + (base - 1)
        ).cast("long"),
    }
    for at, field in enumerate(fields):
        out[f"{field}_mean_career"] = measures.mean(at, career)
        out[f"{field}_mean_season"] = measures.mean(at, in_season)
        out[f"{field}_mean_last5"] = measures.mean(at, recent)
        out[f"{field}_last"] = F.when(first, F.try_element_at(tail, F.lit(-1))[f"v_{at}"]).otherwise(F.col(f"__prev_{at}"))
    return rows.withColumns(out)


def _within_blocks(
    df: DataFrame, part: list[str], season: str, order: list[str], fields: list[str], measures: Measures
) -> DataFrame:
    """Totals that each row sees inside its own block."""
    in_season = Window.partitionBy(*part, season).orderBy(*order)
    in_block = Window.partitionBy(*part).orderBy(season, *order)
    to_date = in_season.rowsBetween(Window.unboundedPreceding, 0)
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    recent = in_block.rowsBetween(-LAST_ROWS, -1)

    rows = df.repartition(*part).select(
        "*",
        F.row_number().over(in_season).alias("__season_row"),
        *[F.sum(name).over(to_date).alias(f"__season{name}") for name in measures.names],
    )
    columns = [F.row_number().over(in_block).alias("__row"), F.lag(season).over(in_block).alias("__prev_season")]
    columns += [F.lag(field).over(in_block).alias(f"__prev_{at}") for at, field in enumerate(fields)]
    for name in measures.names:
        columns += [
            F.sum(name).over(before).alias(f"__sum{name}"),
            F.sum(name).over(recent).alias(f"__recent{name}"),
            F.lag(f"__season{name}").over(in_block).alias(f"__prev_season{name}"),
        ]
    return rows.select("*", *columns)


def _carried(
    df: DataFrame, entity: list[str], season: str, order: list[str], fields: list[str], measures: Measures
) -> DataFrame:
    """One row per block: what all earlier blocks of the entity add up to."""
    part, names = [*entity, BLOCK], measures.names
    seasons = df.groupBy(*part, F.col(season).alias("__season")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(name).alias(name) for name in names]
    )
    totals = ["rows", *names]
    to_date = Window.partitionBy(*entity, "__season").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    seasons = seasons.select("*", *[F.sum(name).over(to_date).alias(f"__to_date{name}") for name in totals])
    end = F.struct(F.col("__season").alias("season"), *[F.col(f"__to_date{name}").alias(name) for name in totals])
    blocks = seasons.groupBy(*part).agg(
        F.max_by(end, "__season").alias("end"), *[F.sum(name).alias(name) for name in totals]
    )
    # the last rows of each block, a limit that Spark applies before the window
    latest = Window.partitionBy(*part).orderBy(*[F.desc(name) for name in (season, *order)])
    tail_row = F.struct(
        *[F.col(name).alias(f"o_{at}") for at, name in enumerate([season, *order])],
        *[F.col(field).alias(f"v_{at}") for at, field in enumerate(fields)],
        *names,
    )
    tails = (
        df.withColumn("__nth", F.row_number().over(latest))
        .where(F.col("__nth") <= LAST_ROWS)
        .groupBy(*part)
        .agg(F.collect_list(tail_row).alias("tail"))
    )
    in_order = Window.partitionBy(*entity).orderBy(BLOCK)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # a block has at least one row, so five blocks hold the last five
    last = F.sort_array(F.flatten(F.collect_list("tail").over(in_order.rowsBetween(-LAST_ROWS, -1))))
    return blocks.join(tails, part).select(
        *part,
        F.lag("end").over(in_order).alias("__end"),
        F.reverse(F.slice(F.reverse(last), 1, LAST_ROWS)).alias("__tail_rows"),
        F.sum("rows").over(before).alias("__prior_rows"),
        *[F.sum(name).over(before).alias(f"__prior{name}") for name in names],
    )
