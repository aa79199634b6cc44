"""Declarative data checks.

Row-wise checks of a table fold into one aggregation over it; each uniqueness check is one
grouping with map-side combining. A check yields one row: how many failures, out of how many.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotmarts.functions.shots import SHOT_EVENTS

# Allowed labels.
STRENGTHS = ("5v5", "PP/SH", "4v4", "3v3", "EN", "other")
RESULTS = ("W", "L", "OTL")

NOT_NULL = "not_null"
UNIQUE = "unique"
UNIQUE_COMBO = "unique_combination"
ACCEPTED = "accepted_values"
EXPRESSION = "expression_is_true"


@dataclass(frozen=True)
class Check:
    """One check. ``columns`` names what it looks at; ``failing`` is the row test, if it is one."""

    kind: str
    table: str
    columns: tuple[str, ...]
    failing: str | None = None
    where: str | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(NOT_NULL, table, (c,), failing=f"{c} is null") for c in columns]


def unique(table: str, column: str) -> Check:
    """Non-NULL values occur once."""
    return Check(UNIQUE, table, (column,))


def unique_combination(table: str, *columns: str) -> Check:
    return Check(UNIQUE_COMBO, table, columns)


def accepted_values(table: str, column: str, values: Sequence[str]) -> Check:
    """The value is in the list, or NULL."""
    listed = ", ".join(f"'{v}'" for v in values)
    return Check(ACCEPTED, table, (column,), failing=f"{column} not in ({listed})")


def expression_true(table: str, column: str, condition: str, where: str | None = None) -> Check:
    """``column condition`` holds or is NULL, over the rows ``where`` selects."""
    return Check(EXPRESSION, table, (column,), failing=f"not ({column} {condition})", where=where)


def _share(table: str, column: str) -> Check:
    return expression_true(table, column, "between 0 and 1")


SUITE: tuple[Check, ...] = (
    unique("stg_players", "player_id"),
    *not_null("stg_players", "player_id"),
    unique("stg_games", "game_id"),
    *not_null("stg_games", "game_id", "game_date"),
    unique_combination("stg_plays", "game_id", "event_id"),
    *not_null("stg_plays", "game_id", "event_id"),
    accepted_values("stg_plays", "event_type", SHOT_EVENTS),
    unique_combination("stg_player_stats", "player_id", "season"),
    *not_null("stg_player_stats", "player_id", "season"),
    expression_true("stg_player_stats", "goals", ">= 0"),
    expression_true("stg_player_stats", "shooting_pct", "between 0 and 100", "shooting_pct is not null"),
    *not_null("stg_xg", "shooter_id", "x_goal"),
    _share("stg_xg", "x_goal"),
    unique_combination("int_shot_events", "game_id", "event_id"),
    *not_null("int_shot_events", "game_id", "event_id", "shooter_id", "period"),
    expression_true("int_shot_events", "period", "between 1 and 5"),
    accepted_values("int_shot_events", "event_type", SHOT_EVENTS),
    expression_true("int_shot_events", "x_goal", "between 0 and 1", "x_goal is not null"),
    unique("shot_events", "event_id_pk"),
    *not_null("shot_events", "event_id_pk", "game_id", "shooter_id", "season", "game_date"),
    expression_true("shot_events", "period", "between 1 and 5"),
    accepted_values("shot_events", "event_type", SHOT_EVENTS),
    accepted_values("shot_events", "strength", STRENGTHS),
    expression_true("shot_events", "x_goal", "between 0 and 1", "x_goal is not null"),
    unique_combination("player_shooting", "shooter_id", "season"),
    *not_null("player_shooting", "shooter_id", "season"),
    expression_true("player_shooting", "sh_pct", "between 0 and 100", "sh_pct is not null"),
    _share("player_shooting", "goals_per_game_pctile"),
    _share("player_shooting", "xg_per_game_pctile"),
    _share("player_shooting", "sh_pct_pctile"),
    _share("player_shooting", "avg_xg_per_shot_pctile"),
    _share("player_shooting", "rebound_shot_pct_pctile"),
    _share("player_shooting", "shot_distance_pctile"),
    _share("player_shooting", "goals_above_expected_pctile"),
    unique_combination("team_season", "season", "team_abbrev"),
    *not_null("team_season", "season", "team_abbrev", "games_played"),
    expression_true("team_season", "wins", ">= 0"),
    expression_true("team_season", "losses", ">= 0"),
    expression_true("team_season", "otl", ">= 0"),
    unique("players", "player_id"),
    *not_null("players", "player_id", "full_name"),
    unique_combination("team_games", "game_id", "team_abbrev"),
    *not_null("team_games", "season", "game_id", "game_date", "team_abbrev"),
    accepted_values("team_games", "result", RESULTS),
)


def _row(check: Check, failures: Column, total: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.label).alias("column_name"),
        failures.cast("bigint").alias("failures"),
        total.cast("bigint").alias("total"),
    )


def row_metrics(checks: Sequence[Check]) -> list[Column]:
    """Failures ``f<i>`` and rows in scope ``t<i>`` of each row-wise check, as aggregates: for one
    pass over a table, or for metrics observed while it is written."""
    totals = []
    for i, check in enumerate(checks):
        scope = F.expr(check.where) if check.where else F.lit(True)
        totals += [
            F.count_if(scope & F.expr(check.failing)).alias(f"f{i}"),
            F.count_if(scope).alias(f"t{i}"),
        ]
    return totals


def observed_results(spark, checks: Sequence[Check], metrics: Mapping[str, int]) -> DataFrame:
    """Check results from the metrics of ``row_metrics`` (a few numbers per check)."""
    rows = [(c.kind, c.table, c.label, metrics[f"f{i}"], metrics[f"t{i}"]) for i, c in enumerate(checks)]
    schema = "check_name string, table_name string, column_name string, failures bigint, total bigint"
    return spark.createDataFrame(rows, schema)


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-wise checks of a table in one pass."""
    results = [_row(check, F.col(f"f{i}"), F.col(f"t{i}")) for i, check in enumerate(checks)]
    return df.agg(*row_metrics(checks)).select(F.inline(F.array(*results)))


def _uniqueness_check(df: DataFrame, check: Check) -> DataFrame:
    """Failures are the keys that occur more than once."""
    if check.kind == UNIQUE:
        df = df.dropna(subset=list(check.columns))
    sizes = df.groupBy(*check.columns).agg(F.count("*").alias("rows"))
    repeated = F.count_if(F.col("rows") > 1)
    total = F.coalesce(F.sum("rows"), F.lit(0))
    counted = sizes.agg(repeated.alias("f"), total.alias("t"))
    return counted.select(F.inline(F.array(_row(check, F.col("f"), F.col("t")))))


def run_checks(table: Mapping[str, DataFrame] | object, checks: Iterable[Check] = SUITE) -> DataFrame:
    """Results of the checks; ``table`` maps table names to frames, or has them as attributes."""

    def frame(name: str) -> DataFrame:
        return table[name] if isinstance(table, Mapping) else getattr(table, name)

    by_rows: dict[str, list[Check]] = {}
    results = []
    for check in checks:
        if check.failing is None:
            results.append(_uniqueness_check(frame(check.table), check))
        else:
            by_rows.setdefault(check.table, []).append(check)
    results += [_row_checks(frame(name), group) for name, group in by_rows.items()]
    return reduce(DataFrame.unionByName, results)


def of_kind(kind: str) -> list[Check]:
    return [check for check in SUITE if check.kind == kind]


def failed(results: DataFrame) -> DataFrame:
    return results.where(F.col("failures") > 0)
