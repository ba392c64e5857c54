"""Column contracts of the bronze, silver and gold datasets.

Parquet tables enforce neither keys nor defaults, so those live in
``matchlake.operators.quality`` as checks; the types are enforced on read and
write by projecting to these schemas.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Dataset -> columns, names and order as users know them.
_BRONZE = {
    "soccer/matches": """
        extract_timestamp timestamp, season string, league string, match_date timestamp,
        home_team string, away_team string, home_goals double, away_goals double,
        home_xg double, away_xg double, venue string, referee string,
        attendance double, match_url string""",
    "soccer/teams": """
        extract_timestamp timestamp, season string, league string, team string,
        matches_played double, wins double, draws double, losses double,
        goals_for double, goals_against double, goal_difference double, points double,
        xg_for double, xg_against double""",
    "soccer/player_stats": """
        extract_timestamp timestamp, season string, league string, match_date timestamp,
        player_name string, team string, opponent string, is_home boolean,
        minutes double, goals double, assists double, shots double, shots_on_target double,
        xg double, xa double""",
    "basketball/games": """
        extract_timestamp timestamp, season string, game_id string, game_date timestamp,
        home_team_id bigint, home_team_name string, away_team_id bigint, away_team_name string,
        home_score bigint, away_score bigint, status string""",
    "basketball/player_stats": """
        extract_timestamp timestamp, season string, game_id string, game_date timestamp,
        player_id bigint, player_name string, team_id bigint, team_name string,
        is_home boolean, minutes double, points bigint, rebounds bigint, assists bigint,
        steals bigint, blocks bigint, turnovers bigint,
        field_goals_made bigint, field_goals_attempted bigint,
        three_pointers_made bigint, three_pointers_attempted bigint,
        free_throws_made bigint, free_throws_attempted bigint, plus_minus double""",
    "basketball/team_stats": """
        extract_timestamp timestamp, season string, team_id bigint, team_name string,
        games_played bigint, wins bigint, losses bigint, offensive_rating double,
        defensive_rating double, net_rating double, pace double""",
    "football/games": """
        extract_timestamp timestamp, season bigint, week bigint, game_id string,
        gameday timestamp, gametime string, home_team string, away_team string,
        home_score bigint, away_score bigint, overtime boolean, game_type string,
        location string, stadium string, roof string, surface string,
        spread_line double, total_line double, result bigint""",
    "football/player_stats": """
        extract_timestamp timestamp, season bigint, week bigint, player_id string,
        player_name string, player_display_name string, team string, position string,
        completions bigint, passing_attempts bigint, passing_yards double,
        passing_tds bigint, interceptions bigint, sacks bigint, passing_air_yards double,
        passing_yards_after_catch double, passing_2pt_conversions bigint,
        carries bigint, rushing_yards double, rushing_tds bigint, rushing_fumbles bigint,
        rushing_2pt_conversions bigint, receptions bigint, targets bigint,
        receiving_yards double, receiving_tds bigint, receiving_air_yards double,
        receiving_yards_after_catch double, receiving_fumbles bigint,
        receiving_2pt_conversions bigint, fantasy_points double""",
    "football/team_stats": """
        extract_timestamp timestamp, season bigint, team string, point_differential bigint,
        games_played bigint, wins bigint, losses bigint, ties bigint, points_for bigint,
        points_against bigint, home_wins bigint, home_losses bigint,
        away_wins bigint, away_losses bigint""",
}

# Gold base tables; the silver datasets have the same columns.
_GOLD = {
    "soccer_matches": """
        match_id string, season string, league string, match_date date, home_team string,
        away_team string, home_goals bigint, away_goals bigint, home_xg double,
        away_xg double, result string, venue string""",
    "soccer_player_matches": """
        match_id string, season string, league string, match_date date, player_name string,
        team string, opponent string, is_home boolean, minutes bigint, goals bigint,
        assists bigint, xg double, xa double, shots bigint, shots_on_target bigint,
        key_passes bigint, tackles bigint, interceptions bigint""",
    "nba_games": """
        game_id string, season string, game_date date, home_team_id bigint, home_team string,
        away_team_id bigint, away_team string, home_score bigint, away_score bigint,
        home_win boolean, total_points bigint""",
    "nba_player_games": """
        game_id string, season string, game_date date, player_id bigint, player_name string,
        team_id bigint, team string, is_home boolean, minutes double, points bigint,
        rebounds bigint, assists bigint, steals bigint, blocks bigint, turnovers bigint,
        field_goal_pct double, three_point_pct double, free_throw_pct double,
        plus_minus double""",
    "nfl_games": """
        game_id string, season bigint, week bigint, game_date date, home_team string,
        away_team string, home_score bigint, away_score bigint, overtime boolean,
        game_type string, stadium string, home_win boolean, total_points bigint""",
    "nfl_players": """
        player_id string, season bigint, week bigint, player_name string, team string,
        position string, completions bigint, passing_attempts bigint, passing_yards double,
        passing_tds bigint, interceptions bigint, sacks bigint, carries bigint,
        rushing_yards double, rushing_tds bigint, rushing_fumbles bigint, receptions bigint,
        targets bigint, receiving_yards double, receiving_tds bigint, fantasy_points double,
        total_yards double, total_tds bigint""",
}

# What landing files hold before any projection.
_RAW = {
    "team_game_log": """
        GAME_ID string, GAME_DATE string, TEAM_ID bigint, TEAM_NAME string, MATCHUP string,
        PTS bigint, WL string, MIN bigint""",
    "player_game_log": """
        SEASON_ID string, PLAYER_ID bigint, PLAYER_NAME string, TEAM_ID bigint,
        TEAM_ABBREVIATION string, TEAM_NAME string, GAME_ID string, GAME_DATE string,
        MATCHUP string, WL string, MIN double, PTS bigint, REB bigint, AST bigint,
        STL bigint, BLK bigint, TOV bigint, FGM bigint, FGA bigint, FG3M bigint,
        FG3A bigint, FTM bigint, FTA bigint, PLUS_MINUS double""",
    "team_metrics": """
        TEAM_ID bigint, TEAM_NAME string, GP bigint, W bigint, L bigint,
        E_OFF_RATING double, E_DEF_RATING double, E_NET_RATING double, E_PACE double""",
    "teams": "id bigint, full_name string, abbreviation string",
    "schedules": """
        game_id string, season bigint, week bigint, gameday string, gametime string,
        home_team string, away_team string, home_score bigint, away_score bigint,
        overtime string, game_type string, location string, stadium string, roof string,
        surface string, spread_line double, total_line double, result bigint""",
    "player_weeks": """
        player_id string, player_name string, player_display_name string, team string,
        position string, season bigint, week bigint, completions bigint, attempts bigint,
        passing_yards double, passing_tds bigint, interceptions bigint, sacks bigint,
        passing_air_yards double, passing_yards_after_catch double,
        passing_2pt_conversions bigint, carries bigint, rushing_yards double,
        rushing_tds bigint, rushing_fumbles bigint, rushing_2pt_conversions bigint,
        receptions bigint, targets bigint, receiving_yards double, receiving_tds bigint,
        receiving_air_yards double, receiving_yards_after_catch double,
        receiving_fumbles bigint, receiving_2pt_conversions bigint, fantasy_points double""",
    "pages": "page_id bigint, url string, html string, league string",
}

# Key, mandatory and defaulted columns of the gold base tables.
GOLD_KEYS = {"soccer_matches": "match_id", "nba_games": "game_id", "nfl_games": "game_id"}
GOLD_MANDATORY = {
    "soccer_matches": ["home_team", "away_team"],
    "soccer_player_matches": ["player_name", "team"],
    "nba_games": ["home_team_id", "home_team", "away_team_id", "away_team"],
    "nba_player_games": ["player_id", "player_name", "team_id", "team"],
    "nfl_games": ["home_team", "away_team"],
}
GOLD_ZERO_DEFAULTS = {
    "soccer_player_matches": [
        "minutes", "goals", "assists", "xg", "xa", "shots", "shots_on_target",
        "key_passes", "tackles", "interceptions",
    ],
    "nba_player_games": [
        "minutes", "points", "rebounds", "assists", "steals", "blocks", "turnovers",
        "plus_minus",
    ],
}


def bronze(dataset: str) -> T.StructType:
    return T.StructType.fromDDL(_BRONZE[dataset])


def gold(table: str) -> T.StructType:
    return T.StructType.fromDDL(_GOLD[table])


def raw(dataset: str) -> T.StructType:
    return T.StructType.fromDDL(_RAW[dataset])


def gold_tables() -> list[str]:
    return list(_GOLD)
