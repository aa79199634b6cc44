"""Raw tables derived from the TPC-H-like trial tables, for tests, checks and benchmarks.

Each rule is a SQL expression that means the same in Spark and in the engine used for checking,
so both start from identical rows. Apart from making games distinct, every table is a row-wise
projection of its source: reading it costs a scan and no shuffle. Ids leave room for any scale:
a game id is start year, two digits of game type and a ten-digit number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Step = Mapping[str, str]

_TEXT = "varchar(20)"


def _pad2(expr: str) -> str:
    return f"lpad(cast({expr} as {_TEXT}), 2, '0')"


def _word(index: str, words: Sequence[str]) -> str:
    """The word at an index, NULL for an empty one, cut out of one literal. A chain of cases would
    evaluate the index once per word."""
    width = max(map(len, words))
    row = "".join(word.ljust(width) for word in words)
    return f"nullif(rtrim(substring('{row}', cast({width} * ({index}) + 1 as int), {width})), '')"


def _game_steps(key: str) -> list[Step]:
    """Season, type, id and teams of a game from its running number."""
    return [
        {"seq": f"cast(({key} - {key} % 25) / 25 as bigint)"},
        {"yr": "seq % 3", "q": "cast((seq - seq % 3) / 3 as bigint)"},
        {"slot": "q % 20"},
        {"kind": "case slot when 0 then 1 when 1 then 3 else 2 end"},
        {
            "game_id": "(2023 + yr) * 1000000000000 + kind * 10000000000 + q",
            "season": "cast((2023 + yr) * 10000 + 2024 + yr as int)",
            "home_team_id": "seq % 25 + 1",
            "away_team_id": "(seq % 25 + 1 + cast((seq - seq % 25) / 25 as bigint) % 24) % 25 + 1",
        },
    ]


GAMES: list[Step] = [
    *_game_steps("o_orderkey")[1:],
    {"away_score_known": "(seq * 7 + 1) % 5", "home_base": "(seq * 5 + 2) % 6"},
    {
        "game_type": "cast(kind as int)",
        "game_date": "case yr when 0 then date '2023-10-10' when 1 then date '2024-10-08'"
        " else date '2025-10-07' end + cast(q % 180 as int)",
        "venue": "concat('Arena ', cast(home_team_id as varchar(20)))",
        "home_team_abbrev": f"concat('T', {_pad2('home_team_id')})",
        "away_team_abbrev": f"concat('T', {_pad2('away_team_id')})",
        "home_score": "cast(case when seq % 37 = 5 then null"
        " when home_base = away_score_known then home_base + 1 else home_base end as int)",
        "away_score": "cast(away_score_known as int)",
        "last_period_type": "case seq % 10 when 3 then 'OT' when 7 then 'SO' else 'REG' end",
    },
]
GAME_COLUMNS = (
    "game_id", "season", "game_type", "game_date", "venue", "home_team_id", "home_team_abbrev",
    "home_score", "away_team_id", "away_team_abbrev", "away_score", "last_period_type",
)

PLAYS: list[Step] = [
    *_game_steps("l_orderkey"),
    {"k": "(l_orderkey * 3 + l_linenumber) % 10"},
    {
        "event_id": "(((l_orderkey % 25) * 8 + l_linenumber) * 8388608 + l_partkey % 8388608)"
        " * 4194304 + (l_suppkey % 65536) * 64 + cast(l_quantity as bigint) % 64",
        "period": "cast(1 + l_partkey % 5 as int)",
        "time_in_period": f"concat({_pad2('cast(l_quantity as bigint) % 20')}, ':',"
        f" {_pad2('l_partkey % 60')})",
        "event_type": _word(
            "k", ["goal", *["shot-on-goal"] * 5, *["missed-shot"] * 2, *["blocked-shot"] * 2]
        ),
        "x_coord": "cast(case when l_partkey % 97 <> 0"
        " then (l_partkey * 7 + l_linenumber * 13) % 199 - 99 end as double)",
        "y_coord": "cast((l_suppkey * 11 + l_linenumber * 5) % 85 - 42 as double)",
        "shot_type": _word(
            "l_partkey % 7", ["wrist", "slap", "snap", "tip-in", "backhand", "wrap-around", ""]
        ),
        "shooter_id": "case when l_partkey % 101 <> 0"
        " then 8470000 + l_suppkey * 5 + least(l_linenumber - 1, 4) end",
        "goalie_id": "cast(null as bigint)",
        "team_id": "case when l_linestatus = 'O' then home_team_id else away_team_id end",
        "situation_code": _word(
            "(l_orderkey + l_partkey) % 11",
            ["0651", "1560", "1541", "1451", "1441", "1331", "1010", "", *["1551"] * 3],
        ),
        "home_defending_side": "case l_returnflag when 'A' then 'left' when 'R' then 'right' end",
        "away_score": "cast(null as int)",
        "home_score": "cast(null as int)",
        "highlight_clip_url": "case when k <> 0 then null"
        " when l_partkey % 3 = 0"
        f" then concat('https://clips.example/v-', cast(l_partkey as {_TEXT}))"
        " when l_partkey % 3 = 1 then '' end",
    },
]
PLAY_SOURCE = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus",
)
PLAY_COLUMNS = (
    "game_id", "event_id", "season", "period", "time_in_period", "event_type", "x_coord",
    "y_coord", "shot_type", "shooter_id", "goalie_id", "team_id", "situation_code",
    "home_defending_side", "away_score", "home_score", "highlight_clip_url",
)

# Expected-goals rows of a shot: itself, a repeat without xG, and one of another season.
XG_BASE: Step = {
    "mp_game_id": "game_id % 1000000000000",
    "start_year": "cast(2023 + yr as int)",
    "elapsed": "cast((period - 1) * 1200 + (cast(l_quantity as bigint) % 20) * 60"
    " + l_partkey % 60 as int)",
    "xg": "round((l_discount * 5 + l_tax) * 100) / 100",
    "rush": "case when l_partkey % 4 = 0 then 1 else 0 end",
    "rebound": "case when l_partkey % 6 = 0 then 1 else 0 end",
}
XG_SHOTS = "event_type <> 'blocked-shot' and shooter_id is not null and l_partkey % 13 <> 0"
XG_REPEATED = "l_partkey % 50 = 1"
XG_OTHER_SEASON = "l_partkey % 41 = 0"
XG_VARIANTS = {
    "true": ("0", "xg", "rush", "rebound"),
    XG_REPEATED: ("0", "cast(0 as double)", "1", "0"),
    XG_OTHER_SEASON: ("1", "cast(0.99 as double)", "0", "0"),
}
XG_COLUMNS: Step = {
    "game_id": "mp_game_id",
    "shooterPlayerId": "cast(shooter_id as double)",
    "shooterName": "concat('Shooter ', cast(shooter_id as varchar(20)))",
    "season": "cast(start_year + shift as int)",
    "team": "case when l_linestatus = 'O' then 'HOME' else 'AWAY' end",
    "period": "period",
    "time": "elapsed",
    "xCordAdjusted": "x_coord",
    "yCordAdjusted": "y_coord",
    "shotType": "shot_type",
    "event": "event_type",
    "shotRush": "cast(rush_flag as int)",
    "shotRebound": "cast(rebound_flag as int)",
    "isPlayoffGame": "case when kind = 3 then 1 else 0 end",
    "xGoal": "xg_value",
}

PLAYERS: list[Step] = [
    {
        "player_id": "8470000 + s_suppkey * 5 + b",
        "first_name": "concat('F', cast(b as varchar(20)))",
        "last_name": "s_name",
        "position": "case b when 0 then 'C' when 1 then 'L' when 2 then 'R' when 3 then 'D'"
        " else 'G' end",
        "headshot_url": "concat('https://faces.example/', cast(s_suppkey * 5 + b as varchar(20)))",
        "team_id": "cast(null as bigint)",
        "team_abbrev": "case when s_suppkey % 11 <> 0"
        f" then concat('T', {_pad2('s_suppkey % 25 + 1')}) end",
        "is_active": "true",
        "sweater_number": "cast(1 + s_suppkey % 98 as int)",
        "height_in": "cast(68 + s_suppkey % 10 as int)",
        "weight_lbs": "cast(180 + s_suppkey % 50 as int)",
        "birth_date": "case when s_suppkey % 17 = 0 then 'n/a' else concat("
        "cast(1985 + s_suppkey % 20 as varchar(20)), '-0', cast(1 + b as varchar(20)), '-15') end",
        "birth_city": "concat('City ', cast(s_nationkey as varchar(20)))",
        "birth_country": "case s_nationkey % 3 when 0 then 'CAN' when 1 then 'USA' else 'SWE' end",
        "shoots_catches": "case s_suppkey % 2 when 0 then 'L' else 'R' end",
    }
]
PLAYER_COLUMNS = tuple(PLAYERS[0])

STATS: list[Step] = [
    {"goals_n": "(player_id + season_id) % 40", "assists_n": "(player_id * 3 + season_id) % 60"},
    {
        "games_played": "cast(20 + player_id % 60 as int)",
        "goals": "cast(goals_n as int)",
        "assists": "cast(assists_n as int)",
        "points": "cast(goals_n + assists_n as int)",
        "plus_minus": "cast(player_id % 41 - 20 as int)",
        "pp_goals": "cast(goals_n % 7 as int)",
        "pp_points": "cast(goals_n % 7 + assists_n % 9 as int)",
        "sh_goals": "cast(goals_n % 2 as int)",
        "sh_points": "cast(goals_n % 2 + assists_n % 3 as int)",
        "shots": "cast(goals_n * 8 as int)",
        "shooting_pct": "cast((player_id * 7) % 200 as double) / 1000",
        "toi_per_game": "cast(600 + (player_id * 13) % 700 as double)",
    },
]
STATS_FILTER = "player_id % 7 <> 0"
STATS_COLUMNS = (
    "player_id", "season_id", "team_abbrev", "position", "games_played", "goals", "assists",
    "points", "plus_minus", "pp_goals", "pp_points", "sh_goals", "sh_points", "shots",
    "shooting_pct", "toi_per_game",
)
SEASONS = (20232024, 20242025, 20252026)


# Source columns in use, so that no file has to be opened to find the schema.
SOURCES = {
    "orders": "o_orderkey bigint",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
}


def _apply(df: DataFrame, steps: list[Step]) -> DataFrame:
    for step in steps:
        df = df.selectExpr("*", *_named(step))
    return df


def _named(step: Step) -> list[str]:
    return [f"{expr} as {name}" for name, expr in step.items()]


class TrialTables:
    """Raw tables over one folder of trial Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.folder}/{name}.parquet")

    def raw_games(self) -> DataFrame:
        seqs = self._source("orders").select(F.expr(_game_steps("o_orderkey")[0]["seq"]).alias("seq"))
        games = _apply(seqs.distinct(), GAMES)
        stamp = F.lit(None).cast("timestamp")
        return games.select(*GAME_COLUMNS).withColumns(
            {"start_time_utc": F.col("game_date").cast("timestamp"), "ingested_at": stamp}
        )

    def _plays(self) -> DataFrame:
        """The columns the rules use are never NULL; saying so shortens the generated code."""
        present = " and ".join(f"{c} is not null" for c in PLAY_SOURCE)
        return _apply(self._source("lineitem").where(present), PLAYS)

    def raw_plays(self) -> DataFrame:
        stamp = F.lit(None).cast("timestamp")
        raw = F.to_json(F.struct(F.col("event_id").alias("eventId")))
        return self._plays().select(
            *PLAY_COLUMNS, raw.alias("raw"), stamp.alias("ingested_at")
        )

    def raw_xg_shots(self) -> DataFrame:
        shots = _apply(self._plays(), [XG_BASE]).where(XG_SHOTS)
        variants = [
            F.when(
                F.expr(condition),
                F.struct(
                    F.expr(shift).alias("shift"),
                    F.expr(xg).alias("xg_value"),
                    F.expr(rush).alias("rush_flag"),
                    F.expr(rebound).alias("rebound_flag"),
                ),
            )
            for condition, (shift, xg, rush, rebound) in XG_VARIANTS.items()
        ]
        spread = shots.select("*", F.inline(F.array_compact(F.array(*variants))))
        return spread.selectExpr(*_named(XG_COLUMNS))

    def raw_players(self) -> DataFrame:
        slots = self._source("supplier").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(4))))
        stamp = F.lit(None).cast("timestamp")
        return _apply(slots, PLAYERS).select(*PLAYER_COLUMNS, stamp.alias("ingested_at"))

    def raw_player_stats(self) -> DataFrame:
        seasons = F.explode(F.array(*[F.lit(s) for s in SEASONS]))
        lines = self.raw_players().where(STATS_FILTER).withColumn("season_id", seasons)
        stamp = F.lit(None).cast("timestamp")
        return _apply(lines, STATS).select(*STATS_COLUMNS, stamp.alias("ingested_at"))
