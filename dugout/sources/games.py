"""Game directories: one JSON or XML document per game and topic.

The landing area is ``year_YYYY/month_MM/day_DD/gid_.../<file>``.  A game without a file simply has no
document, which is what a postponed game looks like.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import baseball as rules
from ..functions.rules import classify, denied, recode
from ..functions.score import innings
from ..functions.timegeo import clock_12h, path_day, path_game_date, path_game_id, zulu
from ..operators.rollup import pitching_scores
from ..operators.shape import conform, one_or_many, re_role
from . import schemas

LINE_SCORE, EVENTS, BOX_SCORE, PLAYERS = "linescore.json", "game_events.json", "boxscore.json", "players.xml"
TOPICS = (LINE_SCORE, EVENTS, BOX_SCORE, PLAYERS)
# fixed values: the files a game directory may offer, below it where a folder is named
MANIFEST = ("game.xml", EVENTS, BOX_SCORE, PLAYERS, LINE_SCORE, "inning/inning_all.xml")


def months_between(start: date, stop: date) -> list[str]:
    """Directory globs of the months that a closed date range touches."""
    globs, day = [], start.replace(day=1)
    while day <= stop:
        globs.append(f"year_{day:%Y}/month_{day:%m}")
        day = (day + timedelta(days=32)).replace(day=1)
    return globs


def read_documents(
    spark: SparkSession, root: str, file_name: str, start: date | None = None, stop: date | None = None
) -> DataFrame:
    """Rows (game_id, game_date, doc) for one topic, one document per row.

    With a date range only the month directories it touches are listed, and day 00 never matches.
    """
    months = "*/*" if start is None or stop is None else "{" + ",".join(months_between(start, stop)) + "}"
    try:
        raw = spark.read.text(f"{root}/{months}/day_*/gid_*/{file_name}", wholetext=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], "game_id string, game_date date, doc string")
    path = F.col("_metadata.file_path")
    docs = raw.select(
        path_game_id(F.regexp_replace(path, "/[^/]*$", "")).alias("game_id"),
        path_game_date(path).alias("game_date"),
        path_day(path).alias("day"),
        F.col("value").alias("doc"),
    )
    docs = docs.filter(F.col("day").isNotNull())
    if start is not None and stop is not None:
        docs = docs.filter(F.col("day").between(F.lit(start), F.lit(stop)))
    return docs.drop("day")


@dataclass(frozen=True)
class Layout:
    """Where a landing area keeps a game's files: globs below the root and how a path names the file."""

    month: str
    rest: str
    file_name: str

    def glob(self, root: str, start: date | None, stop: date | None) -> str:
        """The months that a closed date range touches; day 00 is listed with its month."""
        if start is None or stop is None:
            months = [self.month.replace("{y}", "*").replace("{m}", "*")]
        else:
            days = [tuple(part[-4:] if "year" in part else part[-2:] for part in m.split("/")) for m in months_between(start, stop)]
            months = [self.month.replace("{y}", y).replace("{m}", m) for y, m in days]
        return f"{root}/{{{','.join(months)}}}/{self.rest}"


# fixed values: folder names of the landing area
PLAIN = Layout("year_{y}/month_{m}", "day_*/gid_*", "([^/]*)$")
#: The same levels as partition folders, as Spark itself writes them.
KEYED = Layout("year={y}/month={m}", "day=*/game=gid_*/topic=*", "topic=([^/]*)/[^/]*$")


def list_games(
    spark: SparkSession, root: str, manifest: tuple[str, ...] = TOPICS, start: date | None = None, stop: date | None = None, layout: Layout = PLAIN
) -> DataFrame:
    """(game_id, day, file_name, bytes) of the files that are there, from file metadata alone.

    With a date range only the folders of its months are listed, as far as they exist, and days outside it are dropped;
    files below day 00, which is no date, have a null day and go with their month.
    """
    try:
        files = spark.read.format("binaryFile").load(layout.glob(root.rstrip("/"), start, stop)).select("path", F.col("length").alias("bytes"))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], "game_id string, day date, file_name string, bytes long")
    day = path_day(F.regexp_replace("path", "(year|month|day)=", "$1_"))
    listed = files.select(
        path_game_id(F.regexp_extract("path", r"^(.*gid_[^/]*)/", 1)).alias("game_id"), day.alias("day"), F.regexp_extract("path", layout.file_name, 1).alias("file_name"), "bytes"
    ).filter(F.col("file_name").isin(*manifest))
    if start is not None and stop is not None:
        listed = listed.filter(F.col("day").isNull() | F.col("day").between(F.lit(start), F.lit(stop)))
    return listed


_LINE = """struct<data:struct<game:struct<game_type:string,status:string,home_time:string,game_pk:string,
gameday_sw:string,time:string,ampm:string,home_team_name:string,home_code:string,home_team_city:string,
home_win:string,home_loss:string,home_division:string,home_league_id:string,home_team_id:string,away_code:string,
away_team_city:string,away_win:string,away_loss:string,away_division:string,away_league_id:string,
away_team_id:string,venue_id:string,venue:string,venue_w_chan_loc:string,location:string>>>""".replace("\n", "")


def games(docs: DataFrame) -> DataFrame:
    """Regular-season games with a known team and time, one row per line score."""
    g = docs.withColumn("g", F.from_json("doc", _LINE)["data"]["game"])
    wanted = (F.col("g.game_type") == "R") & (F.col("g.home_team_name") != "TBD") & (F.col("g.time") != "TBD")
    made = {
        "game_type": "game_type", "game_status": "status", "home_time": "home_time", "game_pk": "game_pk",
        "gameday_sw": "gameday_sw", "stadium_id": "venue_id", "stadium_name": "venue",
        "stadium_venue_w_chan_loc": "venue_w_chan_loc",
    }
    for side in ("home", "away"):
        made |= {
            f"{side}_code": f"{side}_code", f"{side}_name": f"{side}_team_city", f"{side}_won": f"{side}_win",
            f"{side}_loss": f"{side}_loss", f"{side}_division": f"{side}_division",
            f"{side}_league": f"{side}_league_id", f"{side}_team_id": f"{side}_team_id",
        }
    rows = g.filter(wanted).select(
        "game_id", "game_date", F.year("game_date").alias("game_year"),
        *[F.col(f"g.{field}").alias(name) for name, field in made.items()],
        F.upper("g.home_code").alias("home_abbrev"), F.upper("g.away_code").alias("away_abbrev"),
        clock_12h(F.col("game_date"), F.col("g.time"), F.col("g.ampm")).alias("game_time_et"),
        F.coalesce("g.location", F.lit("")).alias("stadium_location"),
        F.current_timestamp().alias("modified"),
    )
    return conform(rows, schemas.GAMES)


_EVENT = (
    "struct<event:string,des:string,b:string,s:string,o:string,pitcher:string,batter:string,num:string,"
    "start_tfs_zulu:string,player:string,tfs_zulu:string>"
)
_HALF = "struct<atbat:string,action:string>"
_INNING = f"struct<num:string,top:{_HALF},bottom:{_HALF}>"


def game_events(docs: DataFrame) -> DataFrame:
    """At-bats and actions of every half inning, without the deny-listed ones, with their event codes."""
    node = F.get_json_object("doc", "$.data.game.inning")
    # a single object instead of a list of innings is a game that never started; not a filter, which would take the node out of the document again
    listed = F.when(F.ltrim("node").startswith("["), one_or_many(F.col("node"), _INNING))
    per_inning = docs.withColumn("node", node).select("game_id", "game_date", F.explode(listed).alias("i"))
    halves = F.array(*[F.struct(F.lit(h).alias("top_bottom"), F.col(f"i.{h}").alias("half")) for h in ("top", "bottom")])
    per_half = (
        per_inning.select("game_id", "game_date", F.col("i.num").alias("inning"), F.explode(halves).alias("h"))
        .select("game_id", "game_date", "inning", "h.top_bottom", "h.half.atbat", "h.half.action")
        .filter(F.col("atbat").isNotNull())
    )

    def tagged(column: str, kind: str):
        events = F.coalesce(one_or_many(F.col(column), _EVENT), F.array().cast(f"array<{_EVENT}>"))
        return F.transform(events, lambda e: F.struct(F.lit(kind).alias("kind"), e.alias("e")))

    events = per_half.select(
        "game_id", "game_date", "inning", "top_bottom", F.explode(F.concat(tagged("atbat", "atbat"), tagged("action", "action"))).alias("t")
    ).select("game_id", "game_date", "inning", "top_bottom", "t.kind", "t.e.*")
    is_action = F.col("kind") == "action"
    dropped = F.when(
        is_action, denied(F.col("event"), rules.ACTION_DENY, rules.ACTION_DENY_PREFIXES)
    ).otherwise(denied(F.col("event"), rules.AT_BAT_DENY))
    kept = events.filter(~dropped)
    # one pass over the documents: at-bats keep the roles that they name, actions get theirs
    named = ("num", "pitcher", "batter")
    actors = kept.withColumns({f"__{c}": F.col(c) for c in named} | {"player": F.when(is_action, F.col("player"))})
    roles = re_role(actors, "event", "player", ["Wild Pitch"])
    rows = roles.withColumns(
        {c: F.when(is_action, F.col(c).cast("string")).otherwise(F.col(f"__{c}")) for c in named}
        | {"start_tfs_zulu": F.when(is_action, F.col("tfs_zulu")).otherwise(F.col("start_tfs_zulu"))}
    )
    return conform(
        rows.select(
            "game_id", "game_date", "inning", "top_bottom",
            classify(F.col("event"), rules.EVENT_RULES, F.col("des")).alias("fd_batter_event"),
            "des", F.coalesce("b", F.lit("0")).alias("balls"), F.coalesce("s", F.lit("0")).alias("strikes"),
            F.col("o").alias("outs"), "pitcher", "batter", "num", zulu(F.col("start_tfs_zulu")).alias("start_tfs_zulu"),
            F.current_timestamp().alias("modified"),
        ),
        schemas.GAME_EVENTS,
    )


_PITCHER = (
    "struct<id:string,name:string,name_display_first_last:string,win:string,er:string,so:string,out:string,hr:string,"
    "np:string,s:string,bb:string,sv:string,h:string,r:string,bf:string>"
)
_BOX = (
    "struct<data:struct<boxscore:struct<home_id:string,away_id:string,home_team_code:string,away_team_code:string,"
    "pitching:array<struct<team_flag:string,pitcher:string>>>>>"
)


def pitching_stats(docs: DataFrame) -> DataFrame:
    """Pitchers with at least one pitch; the first one listed for a side is its starter."""
    box = docs.withColumn("b", F.from_json("doc", _BOX)["data"]["boxscore"])
    sides = box.select("game_id", "game_date", "b", F.explode("b.pitching").alias("side"))
    listed = sides.select(
        "game_id", "game_date", "b", F.col("side.team_flag").alias("flag"),
        F.posexplode(one_or_many(F.col("side.pitcher"), _PITCHER)).alias("pos", "p"),
    )
    home = F.col("flag") == "home"
    rows = listed.select(
        "game_id", "game_date", F.col("p.id").alias("player_id"),
        F.when(home, F.col("b.home_id")).otherwise(F.col("b.away_id")).alias("team_id"),
        F.when(home, F.col("b.home_team_code")).otherwise(F.col("b.away_team_code")).alias("team_abbrev"),
        "p.name_display_first_last", "p.name",
        F.when(F.col("p.win") == "true", 1).otherwise(0).alias("win"),
        F.col("p.er").alias("earned_runs"), F.col("p.so").alias("strikeouts"),
        innings(F.col("p.out").try_cast("int")).alias("innings_pitched"), "p.hr",
        F.coalesce("p.np", F.lit("0")).alias("num_pitches"), F.coalesce("p.s", F.lit("0")).alias("num_strikes"),
        F.col("p.bb").alias("num_walks"), F.col("p.h").alias("num_hits"), F.col("p.r").alias("num_runs"),
        (F.col("pos") == 0).alias("is_starter"), F.col("p.bf").alias("batters_faced"),
        F.current_timestamp().alias("modified"),
    )
    typed = conform(rows, schemas.PITCHING_STATS).filter(F.col("num_pitches") > 0)
    return conform(pitching_scores(typed), schemas.PITCHING_STATS)


_ROSTER = (
    "struct<team:array<struct<_type:string,_id:string,player:array<struct<_id:string,_first:string,_last:string,"
    "_boxname:string,_rl:string,_bats:string,_position:string,_status:string,_team_abbrev:string,_team_id:string>>>>>"
)


def game_players(docs: DataFrame) -> DataFrame:
    """Players of both teams as listed for a game."""
    parsed = docs.withColumn("g", F.from_xml("doc", _ROSTER))
    teams = parsed.select("game_id", "game_date", F.explode("g.team").alias("t")).filter(F.col("t._type").isin("home", "away"))
    p = teams.select("game_id", "game_date", F.col("t._id").alias("code"), F.explode("t.player").alias("p"))
    abbrev = F.coalesce("p._team_abbrev", "code")
    position = F.coalesce(F.nullif(F.trim("p._position"), F.lit("")), F.lit("OF"))
    rows = p.select(
        "game_id", "game_date", abbrev.alias("team_abbrev"), F.col("p._id").alias("player_id"),
        F.col("p._first").alias("first_name"), F.col("p._last").alias("last_name"), F.col("p._boxname").alias("box_name"),
        F.concat(F.concat_ws(" ", "p._first", "p._last"), F.lit("_"), abbrev).alias("lookup_name"),
        F.col("p._rl").alias("rl"), F.coalesce("p._bats", F.lit("R")).alias("bats"), position.alias("position"),
        recode(position, rules.POSITION_GROUPS).alias("fd_position"), F.col("p._status").alias("status"),
        F.col("p._team_id").alias("team_id"), F.current_timestamp().alias("modified"),
    )
    return conform(rows, schemas.GAME_PLAYERS)


def missing_files(
    spark: SparkSession, root: str, topics: tuple[str, ...] = TOPICS, start: date | None = None, stop: date | None = None, layout: Layout = PLAIN
) -> DataFrame:
    """(game_id, file_name) pairs a game directory lacks: postponed games and failed fetches."""
    present = list_games(spark, root, topics, start, stop, layout).select("game_id", "file_name")
    wanted = present.select("game_id").distinct().withColumn("file_name", F.explode(F.array(*[F.lit(t) for t in topics])))
    return wanted.join(present, ["game_id", "file_name"], "left_anti")
