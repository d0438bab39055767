"""Declared schemas of the four sources and the required-column check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonlens.functions.feature_lists import (
    QUARTERBACK_STATS,
    RUSHER_RECEIVER_CARRIED,
    RUSHER_RECEIVER_STATS,
)


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


ROSTERS = T.StructType(
    [*_fields(T.StringType(), "player_id", "player_name"), *_fields(T.IntegerType(), "season")]
)

SCHEDULES = T.StructType(
    [
        *_fields(T.StringType(), "game_id"),
        *_fields(T.IntegerType(), "season", "week"),
        *_fields(T.StringType(), "home_team", "away_team"),
        *_fields(T.DoubleType(), "home_score", "away_score"),
    ]
)

#: the column of plays that "first known value" goes by; readers rename another order column to it
PLAY_ORDER = "play_id"

PLAYS = T.StructType(
    [
        *_fields(T.StringType(), "game_id", "posteam", "defteam", "home_team", "away_team", "stadium", "roof"),
        *_fields(T.IntegerType(), "season", "week", "div_game"),
        *_fields(T.StringType(), "game_date"),
        *_fields(T.DoubleType(), "spread_line", "wind", "temp", "kick_distance"),
        *_fields(T.StringType(), "passer_player_id", "passer_player_name", "kicker_player_id",
                 "kicker_player_name", "play_type", "extra_point_result", "field_goal_result"),
        *_fields(T.LongType(), PLAY_ORDER),
    ]
)

WEEKLY = T.StructType(
    [
        *_fields(T.StringType(), "player_id", "player_name", "position", "recent_team", "season_type",
                 "opponent_team"),
        *_fields(T.IntegerType(), "season", "week"),
        *_fields(T.DoubleType(),
                 *dict.fromkeys([*RUSHER_RECEIVER_CARRIED, *RUSHER_RECEIVER_STATS, *QUARTERBACK_STATS])),
    ]
)

SOURCES = {"rosters": ROSTERS, "pbp": PLAYS, "schedules": SCHEDULES, "weekly": WEEKLY}


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` itself, or an error that names the missing columns."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def conform(df: DataFrame, schema: T.StructType, source: str) -> DataFrame:
    """The columns of ``schema`` in their types, or an error that names what ``df`` lacks or has in another type.

    Numbers are cast to the declared kind of number; a text is never read as a number, nor a number as a text.
    """
    missing = [field.name for field in schema.fields if field.name not in df.columns]
    if missing:
        raise ValueError(f"{source}: missing columns: {', '.join(missing)}")
    columns = []
    for field in schema.fields:
        kind = df.schema[field.name].dataType
        if kind != field.dataType and not (isinstance(kind, T.NumericType) and isinstance(field.dataType, T.NumericType)):
            raise ValueError(f"{source}: column {field.name} is {kind.simpleString()}, not {field.dataType.simpleString()}")
        columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*columns)
