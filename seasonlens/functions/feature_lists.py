"""Which statistics get a history and which columns a model sees, per position group."""

from __future__ import annotations

from seasonlens.operators.history import feature_names

TARGET = "fantasy_points_ppr"

# Statistics of runners and receivers that get history features.
RUSHER_RECEIVER_STATS = [
    "rushing_yards", "rushing_tds", "rushing_fumbles", "rushing_fumbles_lost", "rushing_first_downs",
    "rushing_epa", "rushing_2pt_conversions", "receptions", "targets", "receiving_yards", "receiving_tds",
    "receiving_fumbles", "receiving_fumbles_lost", "receiving_air_yards", "receiving_yards_after_catch",
    "receiving_first_downs", "receiving_epa", "receiving_2pt_conversions", "racr", "target_share",
    "air_yards_share", "special_teams_tds", "fantasy_points_ppr",
]

# Statistics of quarterbacks that get history features.
QUARTERBACK_STATS = [
    "completions", "attempts", "passing_yards", "passing_tds", "interceptions", "sacks", "sack_yards",
    "sack_fumbles", "sack_fumbles_lost", "passing_air_yards", "passing_yards_after_catch",
    "passing_first_downs", "passing_epa", "passing_2pt_conversions", "pacr", "dakota", "carries",
    "rushing_yards", "rushing_tds", "rushing_fumbles", "rushing_fumbles_lost", "rushing_first_downs",
    "rushing_epa", "rushing_2pt_conversions", "fantasy_points_ppr",
]

# Statistics of runners and receivers that are carried without a history.
RUSHER_RECEIVER_CARRIED = ["sack_fumbles", "carries"]

# Kick totals of one game, in output order.
KICK_TOTALS = [
    "total_fg_made", "total_fg_missed", "50+_fg_made", "40-49_fg_made", "0-39_fg_made", "missed_fg_0-39",
    "missed_fg_40-49", "missed_fg_50+", "xp_attempt_19y", "xp_made_19y", "xp_attempt_33y", "xp_made_33y",
]

KICKER_STATS = [TARGET, *KICK_TOTALS]

# The columns the kicker model sees.
KICKER_FEATURES = [
    "n_games_career",
    "fantasy_points_ppr_mean_career",
    "fantasy_points_ppr_mean_season_k",
    "fantasy_points_ppr_mean_last5_k",
    "total_fg_made_mean_career",
    "total_fg_missed_mean_career",
    "40-49_fg_made_mean_career",
    "0-39_fg_made_mean_career",
    "missed_fg_50+_mean_career",
    "missed_fg_40-49_mean_career",
    "missed_fg_40-49_mean_season_k",
    "xp_attempt_19y_mean_career",
    "xp_attempt_19y_mean_season_k",
    "xp_attempt_19y_mean_last5_k",
    "xp_made_19y_mean_career",
    "xp_made_19y_mean_season_k",
    "xp_made_19y_mean_last5_k",
    "xp_attempt_33y_mean_career",
    "xp_attempt_33y_mean_season_k",
    "xp_attempt_33y_mean_last5_k",
    "xp_made_33y_mean_career",
    "xp_made_33y_mean_season_k",
    "xp_made_33y_mean_last5_k",
    "n_games_season_def",
    "fantasy_points_ppr_mean_season_def",
    "fantasy_points_ppr_mean_last5_def",
    "50+_fg_made_mean_last5_def",
    "40-49_fg_made_mean_last5_def",
    "xp_attempt_19y_mean_season_def",
    "xp_made_19y_mean_season_def",
    "xp_made_33y_mean_season_def",
    "wind",
]

CONTEXT_FEATURES = ["spread_line", "div_game", "wind", "n_games_career", "n_games_season"]


def rusher_receiver_features(stats: list[str] | None = None) -> list[str]:
    return [*CONTEXT_FEATURES, *feature_names(stats or RUSHER_RECEIVER_STATS)]


def quarterback_features(stats: list[str] | None = None) -> list[str]:
    return ["player_last_fp", *CONTEXT_FEATURES, *feature_names(stats or QUARTERBACK_STATS)]
