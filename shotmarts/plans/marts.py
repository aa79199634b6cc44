"""The marts as one graph over a set of raw tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from shotmarts.plans import players, shots, staging, teams
from shotmarts.sources.tables import staged


def _lazy(df: DataFrame, name: str) -> DataFrame:
    return df


class Marts:
    """Staging frames and marts, each built once from ``raw.raw_games()`` and its siblings.

    ``keep`` says what becomes of a mart that others build on: nothing by default (it stays a
    plan), or a write to storage, after which its readers scan the stored table.
    """

    def __init__(self, raw, keep: Callable[[DataFrame, str], DataFrame] = _lazy):
        self.raw = raw
        self.keep = keep

    @classmethod
    def stored(cls, raw, *names: str) -> Marts:
        """Marts of which the named ones, or all, become staged tables: for those that a query
        reads more than once."""

        def keep(df: DataFrame, name: str) -> DataFrame:
            return staged(df, name) if not names or name in names else df

        return cls(raw, keep=keep)

    @cached_property
    def stg_games(self) -> DataFrame:
        return staging.stg_games(self.raw.raw_games())

    @cached_property
    def stg_plays(self) -> DataFrame:
        return staging.stg_plays(self.raw.raw_plays())

    @cached_property
    def stg_xg(self) -> DataFrame:
        return staging.stg_xg(self.raw.raw_xg_shots())

    @cached_property
    def stg_players(self) -> DataFrame:
        return staging.stg_players(self.raw.raw_players())

    @cached_property
    def stg_player_stats(self) -> DataFrame:
        return staging.stg_player_stats(self.raw.raw_player_stats())

    @cached_property
    def int_shot_events(self) -> DataFrame:
        return shots.int_shot_events(self.stg_plays, self.stg_games, self.stg_xg)

    @cached_property
    def shot_events(self) -> DataFrame:
        mart = shots.shot_events(self.stg_plays, self.stg_games, self.stg_xg)
        return self.keep(mart, "mart_shot_events")

    @cached_property
    def player_shooting(self) -> DataFrame:
        mart = players.player_shooting(self.shot_events, self.stg_player_stats)
        return self.keep(mart, "mart_player_shooting")

    @cached_property
    def players(self) -> DataFrame:
        return self.keep(players.mart_players(self.stg_players), "mart_players")

    @cached_property
    def team_games(self) -> DataFrame:
        return self.keep(teams.team_games(self.stg_games, self.shot_events), "mart_team_games")

    @cached_property
    def team_season(self) -> DataFrame:
        return self.keep(teams.team_season(self.team_games), "mart_team_season")
