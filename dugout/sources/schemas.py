"""Table schemas, written as DDL."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
}


def ddl(text: str) -> T.StructType:
    """Schema from ``name type, ...``; needs no running session."""
    fields = [part.strip().replace("`", "").rsplit(" ", 1) for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


GAMES = ddl(
    """game_id string, game_date date, game_year int, game_type string, game_status string, home_time string,
    game_pk int, gameday_sw string, game_time_et timestamp_ntz, home_code string, home_abbrev string,
    home_name string, home_won int, home_loss int, home_division string, home_league string, home_team_id int,
    away_code string, away_abbrev string, away_name string, away_won int, away_loss int, away_division string,
    away_league string, away_team_id int, stadium_id int, stadium_name string, stadium_venue_w_chan_loc string,
    stadium_location string, modified timestamp"""
)
GAMES_SKIP = ("game_type", "modified", "game_status")

GAME_EVENTS = ddl(
    """game_id string, game_date date, inning int, top_bottom string, fd_batter_event string, des string, balls int,
    strikes int, outs int, pitcher int, batter int, num int, start_tfs_zulu timestamp_ntz, modified timestamp"""
)

GAME_PLAYERS = ddl(
    """game_date date, game_id string, team_abbrev string, player_id int, first_name string, last_name string,
    box_name string, lookup_name string, rl string, bats string, position string, fd_position string, status string,
    team_id int, modified timestamp"""
)
GAME_PLAYERS_SKIP = (
    "game_date", "game_id", "player_id", "modified", "lookup_name", "effective_start_dt", "effective_stop_dt",
)

PITCHING_STATS = ddl(
    """game_id string, game_date date, player_id int, team_id string, team_abbrev string,
    name_display_first_last string, name string, win int, earned_runs int, strikeouts int, innings_pitched double,
    hr int, num_pitches int, num_strikes int, num_walks int, num_hits int, num_runs int, fd_points double,
    is_starter boolean, batters_faced int, non_win_fd_points double, modified timestamp"""
)
PITCHING_SKIP = ("game_id", "modified", "game_date")

WEATHER = ddl(
    """game_id string, game_time_et timestamp_ntz, icon string, nearestStormDistance string, temperature double,
    precipIntensity double, precipProbability double, precipType string, apparentTemperature double,
    dewPoint double, windSpeed double, windBearing double, cloudCover double, humidity double, pressure double,
    visibility double, ozone double, blowing_in boolean, blowing_out boolean"""
)
WEATHER_SKIP = ("game_id", "game_time_et")

STADIUM = ddl(
    """stadium_id int, city string, name string, weather_loco string, has_dome int, capacity double,
    latitude double, longitude double, opened string, center_azimuth int, elevation int"""
)
TEAMS = ddl(
    """team string, eid int, roto string, fulltrans string, ename string, short string, yahoo string, eshort string,
    st string, mlbc string, cbs string, playoffs string"""
)
TEAM_ALIASES = ddl("team string, teamalias string")

CONTEST_CSV = ddl(
    """Position string, `First Name` string, `Last Name` string, Game string, Team string, Salary double,
    FPPG double, Played int, `Probable Pitcher` string, `Injury Indicator` string"""
)
CONTEST = ddl(
    """position string, name string, contest_game string, team string, salary double, points double, num_games int,
    player_status string, injury string"""
)
