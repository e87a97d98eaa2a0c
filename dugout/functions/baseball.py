"""Domain constants.  All of these are fixed values that results depend on."""

from __future__ import annotations

from .rules import Rule

# --- fixed values: event name -> code -------------------------------------------------------------
EVENT_RULES = (
    Rule(
        "O",
        exact=(
            "Groundout", "Lineout", "Flyout", "Force Out", "Forceout", "Grounded Into DP", "Pop Out",
            "Double Play", "Batter Interference", "Bunt Groundout", "Bunt Pop Out", "Triple Play", "Bunt Lineout",
        ),
    ),
    Rule("H", exact=("Single",)),
    Rule("SO", exact=("Strikeout", "Strikeout - DP")),
    Rule("W", exact=("Walk", "Intent Walk")),
    Rule("HR", exact=("Home Run",)),
    Rule("2B", exact=("Double",)),
    Rule("3B", exact=("Triple",)),
    Rule("E", exact=("Field Error", "Error")),
    Rule("SAC", exact=("Sac Fly", "Sac Bunt", "Sac Fly DP", "Sacrifice Bunt DP")),
    Rule("HBP", exact=("Hit By Pitch",)),
    Rule("WP", exact=("Wild Pitch",)),
    Rule("FC", exact=("Fielders Choice", "Fielders Choice Out")),
    Rule("BALK", exact=("Balk",)),
    Rule("SB", prefixes=("Stolen Base",)),
    Rule(
        exact=("Fan interference", "Fan Interference"),
        by_text=(
            ("double", "2B"), ("triples", "3B"), ("out", "O"),
            ("throwing error", "E"), ("fielding error", "E"), ("singles", "H"),
        ),
    ),
)

# --- fixed values: counters raised per code -------------------------------------------------------
# at-bats: every event is one, except these codes
AT_BAT_EXEMPT = ("W", "HBP", "SB", "R", "SAC", "BALK")
COUNTERS = {
    "_1b": {"H": 1},
    "_2b": {"2B": 1},
    "_3b": {"3B": 1},
    "hr": {"HR": 1},
    "r": {"HR": 1, "R": 1},
    "bb": {"W": 1},
    "sb": {"SB": 1},
    "hbp": {"HBP": 1},
    "total_hits": {"H": 1, "2B": 1, "3B": 1, "HR": 1},
}
KNOWN_BATTING_CODES = ("SO", "O", "H", "W", "HR", "HBP", "SB", "2B", "3B", "R", "SAC", "FC", "E", "BALK")
RUN_BATTED_IN = {"HR": 1}
# counts the sentences "<words> scores."; one character before " scores." is enough to tell one, and
# unlike a repeated class it takes linear time on long texts
SCORING_PATTERN = r"[\w ] scores\."

# --- fixed values: score weights ------------------------------------------------------------------
BATTING_WEIGHTS = {
    "_1b": 3.0, "_2b": 6.0, "_3b": 9.0, "hr": 12.0, "rbi": 3.5, "r": 3.2, "bb": 3.0, "sb": 6.0, "hbp": 3.0,
}
BATTING_PART_WEIGHTS = {
    "fd_points_2b": {"_2b": 6.0},
    "fd_points_3b": {"_3b": 9.0},
    "fd_points_hr": {"hr": 12.0},
    "fd_points_sb": {"sb": 6.0},
    "fd_points_out": {},
    "fd_points_tb": {"bb": 1.0, "_1b": 1.0, "_2b": 6.0, "_3b": 9.0, "hr": 12.0},
}
PITCHING_WEIGHTS = {"win": 12.0, "innings_pitched": 3.0, "earned_runs": -3.0, "strikeouts": 3.0}
PITCHING_NON_WIN_WEIGHTS = {"earned_runs": -1.0, "strikeouts": 1.0, "innings_pitched": 1.0}
TARGET_WEIGHTS = {
    "_1b": 1.0, "bb": 1.0, "hr": 4.0, "_3b": 3.0, "_2b": 2.0, "r": 1.0, "rbi": 1.0, "sb": 2.0, "out": -0.25,
    "win": 4.0, "earned_runs": -1.0, "strikeouts": 1.0, "innings_pitched": 1.0,
}

# --- fixed values: rows left out of the event table -----------------------------------------------
AT_BAT_DENY = ("Runner Out", "Catcher Interference")
ACTION_DENY = (
    "Game Advisory", "Pitching Substitution", "Defensive Sub", "Defensive Switch", "Defensive Indiff",
    "Passed Ball", "Offensive sub", "Offensive Sub", "Ejection", "Player Injured", "Runner Out",
    "Runner Advance", "Umpire Substitution", "Batter Turn", "Pitcher Switch", "Manager Review",
    "Umpire Review", "Base Running Double Play",
)
ACTION_DENY_PREFIXES = ("Pickoff", "Picked off", "Caught Stealing")

# --- fixed values: positions, statuses, roster sections -------------------------------------------
POSITION_GROUPS = {"P": ("SP", "RP"), "OF": ("LF", "CF", "RF"), "1B": ("DH",)}
FINISHED = ("Final", "Completed Early")
ACTIVE_SECTIONS = ("Pitchers", "Catchers", "Infielders", "Outfielders", "Designated Hitters")
INACTIVE_SECTIONS = ("Disabled List", "Minors", "Suspended", "Bereavement")

# --- fixed values: trailing windows and measures --------------------------------------------------
HITTER_WINDOWS = ("SEASON", 4, 7, 14, 30)
PITCHER_WINDOWS = ("SEASON", 14, 30, 60)
HITTER_STATS = ("fd_points", "ab", "_1b", "_2b", "_3b", "hr", "rbi", "r", "bb", "sb", "hbp", "out", "total_hits")
PITCHER_STATS = (
    "fd_points", "earned_runs", "hr", "innings_pitched", "num_hits", "num_runs", "num_pitches", "num_walks",
    "num_strikes", "win", "strikeouts", "batters_faced",
)
# points are weighted counts with two decimals at most, innings are thirds: times these they are integers
STAT_SCALES = {"fd_points": 100.0, "innings_pitched": 3.0}
WOBA_WEIGHTS = {"bb": 0.69, "hbp": 0.72, "_1b": 0.89, "_2b": 1.27, "_3b": 1.62, "hr": 2.10}
FIP_CONSTANT = 3.072

# --- fixed values: name spellings tried in this order ---------------------------------------------
ALTERNATE_NAMES = (
    ("MICHAEL", "MIKE"), ("MIKE", "MICHAEL"), ("JACOB", "J.T."), ("NORICHIKA", "NORI"), ("CHI-CHI", "CHI CHI"),
    (" JR.", ""), ("CHARLES", "CHARLIE"), ("CHARLIE", "CHARLES"), ("SKIP", "JARED"), ("CLINTON", "CLINT"),
    ("SAMUEL", "SAM"), ("NATHAN", "NATE"), ("ISAAC", "IKE"),
)

# --- fixed values: weather used for covered stadiums and for missing fields -----------------------
COVERED_WEATHER = {
    "dewPoint": 0.1, "humidity": 0.3, "temperature": 70.0, "apparentTemperature": 70.0, "pressure": 1000.0,
    "windSpeed": 0.0, "cloudCover": 0.0, "precipIntensity": 0.0, "precipProbability": 0.0, "precipType": "",
    "nearestStormDistance": "1000", "ozone": 310.0, "icon": "dome_clear", "visibility": 100.0, "windBearing": 0.0,
}
NO_WEATHER_FALLBACK = ("temperature", "icon")
SECTOR_HALF_WIDTH = 55

# --- fixed values: contest ------------------------------------------------------------------------
SALARY_CAP = 35000
TEAM_LIMIT = 4
ROSTER_SLOTS = ("P", "C", "1B", "2B", "3B", "SS", "OF", "OF", "OF")
PER_SALARY = {"OF": 4}
KEEP_ROSTERS = 30
UNSCORED = -99.0
UNSCORED_TIE_BREAK = -1.0
CONTEST_TEAM_FIXES = {"TAM": "TB"}
CONTEST_TEAM_IDS = {
    "594": "TB", "614": "PIT", "613": "MIL", "609": "WSH", "617": "COL", "615": "STL", "620": "SF", "619": "SD",
    "591": "BAL", "596": "CHW", "610": "CHC", "611": "CIN", "608": "PHI", "606": "MIA", "595": "TOR", "593": "NYY",
    "607": "NYM", "602": "OAK", "604": "TEX", "598": "DET", "599": "KC", "618": "LAD", "612": "HOU", "605": "ATL",
    "616": "ARI", "597": "CLE", "601": "LAA", "600": "MIN", "603": "SEA", "592": "BOS",
}
PROBABLE_CODES = (1, 5)
HITTER_OPEN_CODE = 4
INJURED_CODES = (2, 6)

# --- fixed values: model inputs -------------------------------------------------------------------
CATEGORICAL = (
    "player_id", "stadium_id", "game_time_hour", "game_time_month", "game_weekday", "is_divisional", "game_year",
    "rl", "fd_position", "bats", "status", "isHome", "player_division", "opponent_division", "player_league",
    "opponent_league", "player_team_abbrev", "opponent_team_abbrev", "has_dome", "icon", "blowing_in",
    "blowing_out", "precipType",
)
PITCHER_CATEGORICAL = CATEGORICAL + ("is_starter",)
NOT_FEATURES = (
    "fd_points", "type", "team_abbrev", "stadium_venue_w_chan_loc", "stadium_location", "stadium_name", "last_name",
    "first_name", "box_name", "home_abbrev", "away_abbrev", "home_code", "away_code", "away_name", "home_name",
    "current_position", "position", "gameday_sw", "game_id", "game_pk", "id", "game_date", "lookup_name", "status",
    "is_starter", "player_id", "win", "earned_runs", "strikeouts", "innings_pitched", "_1b", "_2b", "_3b", "hr",
    "rbi", "r", "bb", "sb", "hbp", "out",
)
HITTER_TARGETS = ("fd_points", "_1b", "_2b", "_3b", "hr", "rbi", "r", "bb", "sb", "hbp", "out")
PITCHER_TARGETS = ("fd_points", "win", "earned_runs", "strikeouts", "innings_pitched")
MODEL_DEPTH = 5
MODEL_ROUNDS = 100
MODEL_ROUNDS_PER_TARGET = 1
MODEL_BINS = 300
TRAIN_SHARE = 0.7
SEED = 1
