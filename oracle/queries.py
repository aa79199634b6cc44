"""One statement per registered query."""

from __future__ import annotations

import datetime

from oracle.tables import ZERO, davg, rnd, with_tables

RANGE = "rows between {n} preceding and current row"


def _mean_of_last(expr: str, digits: int, rows: int, keys: str) -> str:
    """Exact mean over the last rows of a numbered log."""
    over = f"(partition by {keys} order by game_num {RANGE.format(n=rows - 1)})"
    return (
        f"(cast(sum(cast({expr} as decimal(18, {digits}))) over {over} as double)"
        f" / nullif(count({expr}) over {over}, 0))"
    )


def _score(column: str) -> str:
    return f"cast(round_even(coalesce({column}, 0) * 100, 0) as bigint)"


def _scores() -> str:
    names = (
        "goals_per_game", "sh_pct", "avg_xg_per_shot", "xg_per_game", "rebound_shot_pct",
        "shot_distance", "goals_above_expected",
    )
    return ", ".join(
        f"{_score(f'{n}_pctile')} as {n}_score, case when {_score(f'{n}_pctile')} >= 67 then 'high'"
        f" when {_score(f'{n}_pctile')} >= 34 then 'medium' else 'low' end as {n}_tier"
        for n in names
    )


def _league_ranks() -> str:
    ranks = {
        "gf": "gf_per_game desc",
        "ga": "ga_per_game asc",
        "xg_diff": "xg_diff_per_game desc",
        "sh_pct": "sh_pct_sog desc",
    }
    placed = ", ".join(
        f"case when {order.split()[0]} is not null then rank() over"
        f" (partition by season order by {order} nulls last) end as {name}_rank"
        for name, order in ranks.items()
    )
    labels = ", ".join(
        f"""coalesce({n}_rank || case when {n}_rank in (1, 21, 31) then 'st'
            when {n}_rank in (2, 22, 32) then 'nd' when {n}_rank in (3, 23, 33) then 'rd'
            else 'th' end, '—') as {n}_place,
        case when {n}_rank is null then null when {n}_rank::double / n_teams <= 0.33::double then 'top'
            when {n}_rank::double / n_teams <= 0.67::double then 'middle' else 'bottom' end as {n}_tier"""
        for n in ranks
    )
    return f"""
        select team_abbrev, season, n_teams, gf_rank, ga_rank, xg_diff_rank, sh_pct_rank, {labels}
        from (select *, count(*) over (partition by season) as n_teams, {placed}
            from mart_team_season)"""


def _records(prefix: str, scope: str) -> str:
    return ", ".join(
        f"count(*) filter ({scope} and result = '{r}') as {prefix}_{r.lower()}"
        for r in ("W", "L", "OTL")
    )


# The rules, written down here on their own, by table name and table read.
_READ = {
    "int_shot_events": "int_shots", "shot_events": "mart_shots", "team_season": "mart_team_season",
    "player_shooting": "mart_player_shooting", "players": "mart_players", "team_games": "mart_team_games",
}
_FILLED = {
    "stg_players": "player_id", "stg_games": "game_id game_date", "stg_plays": "game_id event_id",
    "stg_player_stats": "player_id season", "stg_xg": "shooter_id x_goal",
    "int_shot_events": "game_id event_id shooter_id period",
    "shot_events": "event_id_pk game_id shooter_id season game_date",
    "player_shooting": "shooter_id season", "team_season": "season team_abbrev games_played",
    "players": "player_id full_name", "team_games": "season game_id game_date team_abbrev",
}
_SINGLE = {
    "stg_players": "player_id", "stg_games": "game_id", "shot_events": "event_id_pk", "players": "player_id",
}
_TOGETHER = {
    "stg_plays": "game_id,event_id", "stg_player_stats": "player_id,season",
    "int_shot_events": "game_id,event_id", "player_shooting": "shooter_id,season",
    "team_season": "season,team_abbrev", "team_games": "game_id,team_abbrev",
}
_EVENTS = "goal shot-on-goal missed-shot blocked-shot"
_LISTED = [
    ("stg_plays", "event_type", _EVENTS), ("int_shot_events", "event_type", _EVENTS),
    ("shot_events", "event_type", _EVENTS), ("shot_events", "strength", "5v5 PP/SH 4v4 3v3 EN other"),
    ("team_games", "result", "W L OTL"),
]
#: Table, column, least and greatest value.
_RANGES = [
    ("stg_player_stats", "goals", 0, None), ("stg_player_stats", "shooting_pct", 0, 100),
    ("stg_xg", "x_goal", 0, 1), ("int_shot_events", "period", 1, 5), ("int_shot_events", "x_goal", 0, 1),
    ("shot_events", "period", 1, 5), ("shot_events", "x_goal", 0, 1), ("player_shooting", "sh_pct", 0, 100),
    ("player_shooting", "goals_per_game_pctile", 0, 1), ("player_shooting", "xg_per_game_pctile", 0, 1),
    ("player_shooting", "sh_pct_pctile", 0, 1), ("player_shooting", "avg_xg_per_shot_pctile", 0, 1),
    ("player_shooting", "rebound_shot_pct_pctile", 0, 1), ("player_shooting", "shot_distance_pctile", 0, 1),
    ("player_shooting", "goals_above_expected_pctile", 0, 1), ("team_season", "wins", 0, None),
    ("team_season", "losses", 0, None), ("team_season", "otl", 0, None),
]
#: Ranges over the rows with a value only; the others count all rows.
_WITH_VALUE = {
    ("stg_player_stats", "shooting_pct"), ("int_shot_events", "x_goal"), ("shot_events", "x_goal"),
    ("player_shooting", "sh_pct"),
}


def _verdict(kind: str, table: str, columns: str, failures: str, total: str, source: str = "") -> str:
    return (
        f"select '{kind}' as check_name, '{table}' as table_name, '{columns}' as column_name,"
        f" cast({failures} as bigint) as failures, cast({total} as bigint) as total"
        f" from {source or _READ.get(table, table)}"
    )


def _filled() -> list[str]:
    return [
        _verdict("not_null", t, c, f"count(*) - count({c})", "count(*)")
        for t, columns in _FILLED.items()
        for c in columns.split()
    ]


def _repeated(kind: str, keys: dict[str, str], scope: str) -> list[str]:
    """Keys that occur more than once, found by counting within their own group."""
    found = []
    for table, key in keys.items():
        rows = (
            f"(select count(*) over (partition by {key}) as n, row_number() over (partition by {key}) as k"
            f" from {_READ.get(table, table)} {scope.format(key=key)})"
        )
        found.append(_verdict(kind, table, key, "count(*) filter (n > 1 and k = 1)", "count(*)", rows))
    return found


def _listed() -> list[str]:
    return [
        _verdict("accepted_values", t, c, f"count(*) filter (not list_contains({v.split()}, {c}))", "count(*)")
        for t, c, v in _LISTED
    ]


def _ranges() -> list[str]:
    found = []
    for table, column, least, most in _RANGES:
        outside = f"{column} < {least}" + (f" or {column} > {most}" if most is not None else "")
        total = f"count({column})" if (table, column) in _WITH_VALUE else "count(*)"
        found.append(_verdict("expression_is_true", table, column, f"count(*) filter ({outside})", total))
    return found


def _all(parts: list[str]) -> str:
    return " union all ".join(parts)

_KNOWN = "case when cast(substring(team_abbrev, 2) as integer) % 2 = 0 then 'Team ' || substring(team_abbrev, 2) end"
_CLIP = "event_type = 'goal' and highlight_clip_url is not null and highlight_clip_url <> ''"
_GAME = """game_id, season, game_type, game_date, venue, home_team_id, home_team_abbrev, home_score,
    away_team_id, away_team_abbrev, away_score, last_period_type"""
_XG_DISPLAY = f"{rnd('total_xg', 1)} as total_xg, {rnd('xg_per_game', 3)} as xg_per_game"


_CARD = f"""
            select player_id, season, full_name, position, team_abbrev, headshot_url, team_logo_url,
                games_played, goals, shots_on_goal, sh_pct, {_XG_DISPLAY}, goals_per_game_pctile,
                sh_pct_pctile, avg_xg_per_shot_pctile, xg_per_game_pctile, rebound_shot_pct_pctile,
                shot_distance_pctile, goals_above_expected, goals_above_expected_pctile,
                sweater_number, height_in, weight_lbs, birth_country, shoots_catches, birth_date
            from ranked_players"""
_ROSTER = f"""
            select team_abbrev, season, player_id, full_name, last_name, position, headshot_url,
                team_logo_url, games_played, goals, coalesce(assists, 0) as assists,
                coalesce(points, 0) as points, shots_on_goal, sh_pct, {_XG_DISPLAY},
                goals_above_expected as gax
            from ranked_players where team_abbrev is not null"""
_LEADERS = f"""
    select season, player_id, full_name, position, team_abbrev, headshot_url, team_logo_url,
        games_played, goals, shots_on_goal, sh_pct, {_XG_DISPLAY}, xg_per_game_pctile, total_xg as total
    from (select *, row_number() over (
            partition by season order by total_xg desc nulls last, player_id) as place
        from ranked_players) where place <= 20"""
#: Keys of the queries for one player or team.
_PLAYER, _TEAM, _SEASON = 8470249, "T02", 20242025


def statements(as_of: datetime.date, year: int) -> dict[str, str]:
    """SQL by registered name; the arguments are those the queries are run with."""
    queries = {
        # loads
        "ingest_games": f"select {_GAME} from raw_games where home_score is not null",
        "append_new_games": """
            select *, case when season < 20252026 then 'stored' else 'new' end as origin
            from raw_games""",
        "ingest_plays": "select * from raw_plays",
        "ingest_plays_raw_json": """
            select game_id, event_id, event_type, x_coord, period, shooter_id, highlight_clip_url
            from raw_plays""",
        "completed_games": f"""
            select game_id, season from raw_games
            where home_score is not null
                and game_date between date '{as_of - datetime.timedelta(days=3)}' and date '{as_of}'""",
        "unprocessed_games": """
            select g.game_id, g.season from raw_games g
            where home_score is not null and not exists (
                select 1 from raw_plays p where p.game_id = g.game_id and p.season < 20252026)""",
        "ingest_roster": "select * from raw_players",
        "current_teams": "select distinct home_team_abbrev as team_abbrev from raw_games",
        "upsert_players": """
            select * replace (
                case when team_abbrev is null then sweater_number else sweater_number + 2 end
                    as sweater_number)
            from raw_players where position <> 'G' or team_abbrev is not null""",
        "ingest_skater_stats": """
            select * replace (coalesce(team_abbrev, '') as team_abbrev,
                nullif(shooting_pct, 0) as shooting_pct) from raw_player_stats""",
        "replace_season": """
            select * replace (if(season_id = 20242025, goals + 1, goals)::integer as goals)
            from raw_player_stats""",
        "seasons_to_refresh": f"""
            select distinct season from raw_plays where season not in (
                select season_id from raw_player_stats where season_id % 10000 < {year})""",
        "ingest_xg": "select * from raw_xg_shots",
        "write_games": "select * from raw_plays",
        "materialise": "select * from mart_shots",
        # staging and scalar expressions
        "stg_games": "select * from stg_games",
        "stg_plays": "select * from stg_plays",
        "stg_xg": "select * from stg_xg",
        "stg_players": "select * from stg_players",
        "stg_player_stats": "select * from stg_player_stats",
        "parse_situation": """
            select game_id, event_id, situation_code, away_goalie, away_skaters, home_skaters,
                home_goalie from parsed""",
        "clock_seconds": """
            select game_id, event_id, time_in_period, seconds_in_period,
                cast((period - 1) * 1200 + seconds_in_period as integer) as elapsed_seconds
            from parsed""",
        "net_x": "select game_id, event_id, net_x from int_shots",
        "shot_geometry": "select game_id, event_id, net_x, shot_distance, shot_angle from int_shots",
        "strength_state": "select game_id, event_id, is_empty_net, strength from int_shots",
        "surrogate_key": """
            select game_id, event_id,
                md5(cast(game_id as varchar(30)) || '-' || cast(event_id as varchar(30))) as event_id_pk
            from stg_plays""",
        "season_label": """
            select game_id, substring(cast(season as varchar(8)), 1, 4) || '-'
                || substring(cast(season as varchar(8)), 5, 4) as season_label from stg_games""",
        "clip_content_id": """
            select game_id, event_id, highlight_clip_url,
                regexp_extract(highlight_clip_url, '([^-]*)$', 1) as content_id
            from mart_shots where highlight_clip_url <> ''""",
        "player_bio": """
            select player_id, full_name, (height_in // 12) || '''' || (height_in % 12) || '"' as height_label,
                concat_ws(' · ', '#' || sweater_number,
                    (height_in // 12) || '''' || (height_in % 12) || '"', weight_lbs || ' lbs',
                    'DOB: ' || strftime(birth_date, '%m/%d/%Y'), 'Shoots ' || shoots_catches) as bio_text
            from mart_players""",
        # marts
        "xg_dedupe": "select * from int_shots_xg",
        "xg_enrich": "select game_id, event_id, x_goal, is_rush, is_rebound from int_shots",
        "xg_enrich_season": """
            select game_id, event_id, x_goal, is_rush, is_rebound from int_shots_season""",
        "int_shot_events": """
            select game_id, event_id, season, period, time_in_period, seconds_in_period, event_type,
                x_coord, y_coord, shot_type, shooter_id, goalie_id, team_id, situation_code,
                away_skaters, home_skaters, away_goalie, home_goalie, home_defending_side,
                away_score, home_score, highlight_clip_url, net_x, shot_distance, shot_angle,
                is_empty_net, strength, x_goal, is_rush, is_rebound
            from int_shots""",
        "shot_events": "select * from mart_shots",
        "player_season": "select * from season_profiles",
        "player_shooting": "select * from mart_player_shooting",
        "mart_players": "select * from mart_players",
        "team_perspective": "select * from perspectives",
        "team_shot_stats": "select * from shot_sides",
        "team_games": "select * from mart_team_games",
        "team_season": "select * from mart_team_season",
        # players
        "league_stats": f"""
            select m.season,
                {rnd(davg("m.goals_per_game", 3) + " * 2", 2)} as avg_goals_per_game,
                {rnd(davg("m.xg_per_game", 3) + " * 2", 3)} as avg_xg_per_game,
                {rnd(davg("m.sh_pct", 1), 1)} as league_sh_pct,
                (select count(distinct s.game_id) from mart_shots s where s.season = m.season)
                    as games_played
            from mart_player_shooting m group by m.season""",
        "leaderboard": f"""
            select season, player_id, full_name, position, team_abbrev, headshot_url, team_logo_url,
                games_played, goals, shots_on_goal, sh_pct, {_XG_DISPLAY}, xg_per_game_pctile
            from (select *, row_number() over (
                    partition by season order by total_xg desc nulls last, player_id) as place
                from ranked_players) where place <= 20""",
        "player_card": _CARD,
        "percentile_scores": f"select shooter_id, season, {_scores()} from mart_player_shooting",
        "player_shots": "select * from map_shots",
        "player_game_log": "select * from player_log",
        "player_rolling_xg": f"""
            select shooter_id, season, game_id, team_id, game_num, xg,
                {_mean_of_last("xg", 3, 5, "shooter_id, season")} as rolling_xg from player_log""",
        "goal_games": "select * from player_log where goals > 0",
        "season_players": "select season, player_id, full_name, position, team_abbrev from ranked_players",
        "teams_in_season": """
            select distinct season, team_abbrev from ranked_players where team_abbrev is not null""",
        "player_card_one": f"select * from ({_CARD}) where player_id = {_PLAYER} and season = {_SEASON}",
        "player_shots_one": f"select * from map_shots where shooter_id = {_PLAYER} and season = {_SEASON}",
        "player_game_log_one": f"""
            select *, cast(rank() over (order by game_id, team_id) as integer) as place
            from player_log where shooter_id = {_PLAYER} and season = {_SEASON}""",
        "leaderboard_one": f"""
            select * exclude (total),
                cast(rank() over (order by total desc nulls last, player_id) as integer) as place
            from ({_LEADERS}) where season = {_SEASON}""",
        "team_game_log_one": f"""
            select *, cast(rank() over (order by game_id) as integer) as place
            from team_log where team_abbrev = '{_TEAM}' and season = {_SEASON}""",
        "team_roster_sorted": f"""
            select *, cast(rank() over (order by goals desc nulls last, player_id) as integer) as place
            from ({_ROSTER}) where team_abbrev = '{_TEAM}' and season = {_SEASON}""",
        "player_season_log": f"""
            select shooter_id, season, games_played, goals, shots_on_goal, sh_pct, {_XG_DISPLAY},
                goals_above_expected from mart_player_shooting""",
        "available_seasons": """
            select distinct season, substring(cast(season as varchar(8)), 1, 4) || '-'
                || substring(cast(season as varchar(8)), 5, 4) as season_label
            from mart_player_shooting""",
        # shots on the map
        "filter_options": """
            select distinct 'strength' as option, strength as value from map_shots where strength is not null
            union select distinct 'period', cast(period as varchar(9)) from map_shots
            union select distinct 'event_type', event_type from map_shots""",
        "shots_filtered": """
            select * from map_shots where strength in ('5v5', 'PP/SH')
                and event_type in ('goal', 'shot-on-goal') and period is not null""",
        "shots_normalised": f"""
            select * replace (case when net_x < 0 then -x_coord + {ZERO} else x_coord end as x_coord,
                case when net_x < 0 then -y_coord + {ZERO} else y_coord end as y_coord)
            from map_shots""",
        "shot_class": """
            select game_id, shooter_id, event_type, case when event_type = 'goal' then 'goal'
                when event_type = 'blocked-shot' then 'blocked' else 'other' end as shot_class
            from map_shots""",
        "shots_by_type": "select * from map_shots where shot_type = 'wrist'",
        "xg_clipped": """
            select game_id, shooter_id, x_goal,
                case when x_goal is null or x_goal < 0 then 0 when x_goal > 0.5 then 0.5
                    else x_goal end::double as xg_display
            from map_shots""",
        "shot_labels": """
            select s.game_id, s.shooter_id, s.season, s.period, s.time_in_period, l.opponent, l.is_home,
                coalesce(strftime(s.game_date, '%b %d'), '—') as date_label,
                case when l.is_home is null or l.is_home then 'vs ' else 'at ' end
                    || coalesce(l.opponent, '—') as opponent_label
            from map_shots s left join player_log l using (shooter_id, season, game_id, team_id)""",
        "shots_selected_games": """
            select * from map_shots where (shooter_id, season, game_id) in (
                select (shooter_id, season, game_id) from player_log where goals >= 2)""",
        "shot_type_breakdown": f"""
            select shooter_id, season, shot_type, shots, goals,
                round_even(goals::double / shots * 100, 1) + {ZERO} as sh_pct,
                round_even(shots::double / sum(shots) over (partition by shooter_id, season) * 100, 1)
                    + {ZERO} as volume_pct
            from (select shooter_id, season, shot_type, count(event_type) as shots,
                    count(*) filter (event_type = 'goal') as goals
                from map_shots where shot_type is not null group by shooter_id, season, shot_type)""",
        "goal_clips": f"""
            select s.shooter_id, s.season, s.game_id, s.period, s.time_in_period,
                s.highlight_clip_url, l.game_num, l.opponent, l.is_home
            from map_shots s left join player_log l using (shooter_id, season, game_id, team_id)
            where {_CLIP}""",
        "first_goal_clip": f"""
            select shooter_id, season, game_id, highlight_clip_url as clip_url
            from (select *, row_number() over (partition by shooter_id, season, game_id
                    order by period, time_in_period, highlight_clip_url) as place
                from map_shots where {_CLIP}) where place = 1""",
        # teams
        "team_card": """
            select team_abbrev, season, games_played, wins, losses, otl, points, goals_for, xg_for,
                sh_pct, goals_against, xg_against, xg_differential, sh_pct_sog, sv_pct
            from mart_team_season""",
        "team_game_log": "select * from team_log",
        "last_10_games": """
            select * from (select *, row_number() over (
                    partition by team_abbrev, season order by game_id desc) as recency
                from team_log) where recency <= 10""",
        "split_records": f"""
            select team_abbrev, season, {_records("home", "is_home")}, {_records("away", "not is_home")},
                {_records("last", "recency <= 10")}
            from (select *, row_number() over (
                    partition by team_abbrev, season order by game_id desc) as recency
                from mart_team_games) group by team_abbrev, season""",
        "team_rolling_xg_pct": f"""
            select team_abbrev, season, game_id, game_num, pct as rolling_xg_pct,
                greatest(pct, 50::double) as above_even, least(pct, 50::double) as below_even
            from (select *, round_even({_mean_of_last("share", 8, 10, "team_abbrev, season")}, 1)
                    + {ZERO} as pct
                from (select *, coalesce(xg_for / nullif(xg_for + xg_against, 0) * 100, 50) as share
                    from team_log))""",
        "league_table": """
            select team_abbrev, season, games_played, gf_per_game, ga_per_game, xg_for_per_game,
                xg_against_per_game, xg_diff_per_game, sh_pct, sh_pct_sog, sv_pct
            from mart_team_season""",
        "league_ranks": _league_ranks(),
        "team_roster": _ROSTER,
        "team_names": f"""
            select team_abbrev, season, coalesce({_KNOWN}, team_abbrev) as team_name
            from mart_team_season""",
        # checks
        "dq_not_null": _all(_filled()),
        "dq_unique": _all(_repeated("unique", _SINGLE, "where {key} is not null")),
        "dq_unique_combo": _all(_repeated("unique_combination", _TOGETHER, "")),
        "dq_accepted": _all(_listed()),
        "dq_expression": _all(_ranges()),
    }
    return {name: with_tables(sql) for name, sql in queries.items()}
