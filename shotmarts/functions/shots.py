"""Column expressions about one shot: clock, situation, target net, geometry, strength, class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shotmarts.functions.numeric import clip, round_half_up

# Event vocabulary, net position in feet, clock length and display range.
SHOT_EVENTS = ("goal", "shot-on-goal", "missed-shot", "blocked-shot")
ON_GOAL_EVENTS = ("shot-on-goal", "goal")
NET_X = 89.0
PERIOD_SECONDS = 1200
XG_DISPLAY_MAX = 0.5
SITUATION_SLOTS = ("away_goalie", "away_skaters", "home_skaters", "home_goalie")


def _to_int(c: Column, strict: bool) -> Column:
    return c.cast("int") if strict else c.try_cast("int")


def parse_situation(code: Column, strict: bool = True) -> dict[str, Column]:
    """The four digits of a situation code. A short code raises, or gives NULL if not strict."""
    return {
        name: _to_int(F.substring(code, position, 1), strict)
        for position, name in enumerate(SITUATION_SLOTS, start=1)
    }


def clock_seconds(clock: Column, strict: bool = True) -> Column:
    """``MM:SS`` to seconds within the period."""
    minutes = F.split_part(clock, F.lit(":"), F.lit(1))
    seconds = F.split_part(clock, F.lit(":"), F.lit(2))
    return _to_int(minutes, strict) * 60 + _to_int(seconds, strict)


def elapsed_seconds(period: Column, seconds_in_period: Column) -> Column:
    """Seconds since the start of the game."""
    return (period - 1) * PERIOD_SECONDS + seconds_in_period


def game_number(game_id: Column, strict: bool = True) -> Column:
    """Game id without its four-digit start year: the id used by the expected-goals file. A shorter id
    raises, or gives NULL if not strict."""
    digits = F.substring(game_id.cast("string"), 5, 30)
    return digits.cast("bigint") if strict else digits.try_cast("bigint")


def net_x(team: Column, home: Column, away: Column, home_side: Column, x: Column) -> Column:
    """x of the net shot at. With no known side or team, the net on the shot's half."""
    known = home_side.isin("left", "right")
    shoots_far = (
        F.when(known & (team == home), home_side == "left")
        .when(known & (team == away), home_side == "right")
        .otherwise(x >= 0)
    )
    return F.when(shoots_far, F.lit(NET_X)).otherwise(F.lit(-NET_X))


def shot_distance(x: Column, y: Column, net: Column) -> Column:
    return round_half_up(F.sqrt((x - net) * (x - net) + y * y), 2, signed=False)


def shot_angle(x: Column, y: Column, net: Column) -> Column:
    return round_half_up(F.degrees(F.atan2(F.abs(y), F.abs(net - x))), 2, signed=False)


def is_empty_net(
    team: Column, home: Column, away: Column, home_goalie: Column, away_goalie: Column
) -> Column:
    """True if the defending goalie is off the ice; false when that is not known."""
    against_away = (team == home) & (away_goalie == 0)
    against_home = (team == away) & (home_goalie == 0)
    return F.coalesce(against_away, F.lit(False)) | F.coalesce(against_home, F.lit(False))


def strength(empty_net: Column, home_skaters: Column, away_skaters: Column) -> Column:
    """Manpower label; an empty net takes precedence."""
    even = away_skaters == home_skaters
    return (
        F.when(empty_net, "EN")
        .when(even & (away_skaters == 5), "5v5")
        .when(even & (away_skaters == 4), "4v4")
        .when(even & (away_skaters == 3), "3v3")
        .when(~even, "PP/SH")
        .otherwise("other")
    )


def shot_class(event_type: Column) -> Column:
    """Class a shot is drawn in: goal, blocked or other."""
    return (
        F.when(event_type == "goal", "goal")
        .when(event_type == "blocked-shot", "blocked")
        .otherwise("other")
    )


def mirrored(coordinate: Column, net: Column) -> Column:
    """Coordinate seen with the target net on the positive side."""
    return F.when(net < 0, F.lit(0.0) - coordinate).otherwise(coordinate)


def is_on_goal(event_type: Column) -> Column:
    return event_type.isin(*ON_GOAL_EVENTS)


def is_goal(event_type: Column) -> Column:
    return event_type == "goal"


def is_unblocked(event_type: Column) -> Column:
    return event_type != "blocked-shot"


def has_clip(url: Column) -> Column:
    return url.isNotNull() & (url != "")


def display_xg(x_goal: Column) -> Column:
    return clip(x_goal, 0.0, XG_DISPLAY_MAX)
