"""A small invented season on disk."""

from __future__ import annotations

import json
from datetime import date, timedelta

TEAMS = {"sfn": ("SF", 10), "oak": ("OAK", 20), "bos": ("BOS", 30)}
FIRST = date(2015, 4, 2)
HITTERS = {"sfn": range(100, 106), "oak": range(200, 206), "bos": range(300, 306)}
PITCHERS = {"sfn": (190, 191), "oak": (290, 291), "bos": (390, 391)}
POSITIONS = ["C", "2B", "3B", "SS", "LF", "DH"]


def game_path(root, day, away, home, number=1):
    name = f"gid_{day:%Y_%m_%d}_{away}mlb_{home}mlb_{number}"
    path = root / f"year_{day:%Y}" / f"month_{day:%m}" / f"day_{day:%d}" / name
    path.mkdir(parents=True, exist_ok=True)
    return path, name


def line_score(home, away, **changes):
    game = {
        "game_type": "R", "status": "Final", "home_time": "7:05", "game_pk": "1", "gameday_sw": "P", "time": "7:05", "ampm": "PM",
        "home_team_name": home, "venue_id": "1", "venue": "Park", "location": "Town", "venue_w_chan_loc": "X",
    }
    for side, team in (("home", home), ("away", away)):
        game |= {
            f"{side}_code": team, f"{side}_team_city": team.title(), f"{side}_win": "3", f"{side}_loss": "1", f"{side}_division": "W",
            f"{side}_league_id": "NL" if team == "sfn" else "AL", f"{side}_team_id": str(TEAMS[team][1]),
        }
    game |= changes
    return {"data": {"game": {k: v for k, v in game.items() if v is not None}}}


def at_bat(event, batter, pitcher, des="", **more):
    return {"event": event, "des": des, "b": "1", "s": "2", "o": "1", "pitcher": str(pitcher), "batter": str(batter), "num": "1", "start_tfs_zulu": "2015-04-03T00:08:57Z"} | more


def innings(home, away, n):
    names = ["Single", "Groundout", "Home Run", "Walk", "Double", "Strikeout"]
    top = [at_bat(names[(i + n) % 6], b, PITCHERS[home][0], "A B homers. C D scores. " if (i + n) % 6 == 2 else "") for i, b in enumerate(HITTERS[away])]
    bottom = [at_bat(names[(i + n + 1) % 6], b, PITCHERS[away][0]) for i, b in enumerate(HITTERS[home])]
    actions = [
        {"event": "Stolen Base 2B", "des": "", "o": "1", "player": str(HITTERS[away][0]), "tfs_zulu": ""},
        {"event": "Wild Pitch", "des": "", "o": "1", "player": str(PITCHERS[home][0]), "tfs_zulu": "2015-04-03T00:10:00Z"},
        {"event": "Pickoff 1B", "des": "", "o": "1", "player": "1", "tfs_zulu": ""},
        {"event": "Manager Review", "des": "", "o": "1", "player": "1", "tfs_zulu": ""},
    ]
    return [
        {"num": "1", "top": {"atbat": top, "action": actions}, "bottom": {"atbat": bottom, "action": actions[2]}},
        {"num": "2", "top": {"atbat": at_bat("Home Run", HITTERS[away][1], PITCHERS[home][1], start_tfs_zulu="")}},
        {"num": "3", "top": {"atbat": [at_bat("Runner Out", HITTERS[away][1], 1), at_bat("Flyout", HITTERS[away][1], PITCHERS[home][0])]}, "bottom": {"action": actions}},
    ]


def box_score(home, away):
    def pitcher(pid, outs, **more):
        return {"id": str(pid), "name": f"p{pid}", "name_display_first_last": f"F p{pid}", "er": "2", "so": "7", "out": str(outs), "hr": "1", "np": "90", "s": "60",
                "bb": "2", "sv": "0", "h": "5", "r": "2", "bf": "25"} | more

    second = pitcher(PITCHERS[home][1], 3)
    del second["np"]
    sides = [
        {"team_flag": "home", "pitcher": [pitcher(PITCHERS[home][0], 18, win="true"), second]},
        {"team_flag": "away", "pitcher": pitcher(PITCHERS[away][0], 24)},
    ]
    return {"data": {"boxscore": {"home_id": str(TEAMS[home][1]), "away_id": str(TEAMS[away][1]), "home_team_code": home, "away_team_code": away, "pitching": sides}}}


def players_xml(home, away, traded=None):
    out = ["<game>"]
    for side, team in (("away", away), ("home", home)):
        code, number = TEAMS[team]
        out.append(f'<team type="{side}" id="{code}">')
        for i, pid in enumerate([*HITTERS[team], *PITCHERS[team]]):
            position = POSITIONS[i] if i < 6 else "SP"
            status = "D" if pid == traded else "A"
            bats = "" if i == 0 else ' bats="L"'
            place = "" if i == 1 else f' team_id="{number}"'
            out.append(f'<player id="{pid}" first="F{pid}" last="L{pid}" boxname="B" rl="R"{bats} position="{position if i != 2 else ""}" status="{status}"{place}/>')
        out.append("</team>")
    out.append("</game>")
    return "".join(out)


def write_season(root, days=8):
    """One game per day in rotation; day 3 is postponed, the last one has not been played."""
    pairs = [("oak", "sfn"), ("bos", "oak"), ("sfn", "bos")]
    names = []
    for n in range(days):
        day = FIRST + timedelta(days=n)
        away, home = pairs[n % 3]
        path, name = game_path(root, day, away, home)
        names.append(name)
        last = n == days - 1
        if n == 3:
            continue
        score = line_score(home, away, status="Preview" if last else "Final", time="12:35" if n == 1 else "7:05", venue_id=str(1 + n % 2))
        (path / "linescore.json").write_text(json.dumps(score))
        (path / "players.xml").write_text(players_xml(home, away, traded=HITTERS[home][3] if n == 4 else None))
        if not last:
            (path / "game_events.json").write_text(json.dumps({"data": {"game": {"inning": innings(home, away, n)}}}))
            (path / "boxscore.json").write_text(json.dumps(box_score(home, away)))
    extra, _ = game_path(root, FIRST, "bos", "oak", 2)
    (extra / "linescore.json").write_text(json.dumps(line_score("oak", "bos", game_type="S")))
    (extra / "game_events.json").write_text(json.dumps({"data": {"game": {"inning": {"num": "1"}}}}))
    return names
