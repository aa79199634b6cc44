"""Schemas of the raw tables and of the landed documents.

Ids are 64-bit: real ids fit in 32, but nothing here should break when ids grow with the data.
Documents carry a small envelope (``doc_ts`` and what was asked for) set when they are landed.
"""

from __future__ import annotations

RAW_GAMES = """
    game_id bigint, season int, game_type int, game_date date, start_time_utc timestamp,
    venue string, home_team_id bigint, home_team_abbrev string, home_score int,
    away_team_id bigint, away_team_abbrev string, away_score int, last_period_type string,
    ingested_at timestamp
"""

RAW_PLAYS = """
    game_id bigint, event_id bigint, season int, period int, time_in_period string,
    event_type string, x_coord double, y_coord double, shot_type string, shooter_id bigint,
    goalie_id bigint, team_id bigint, situation_code string, home_defending_side string,
    away_score int, home_score int, highlight_clip_url string, raw string, ingested_at timestamp
"""

RAW_PLAYERS = """
    player_id bigint, first_name string, last_name string, position string, headshot_url string,
    team_id bigint, team_abbrev string, is_active boolean, sweater_number int, height_in int,
    weight_lbs int, birth_date string, birth_city string, birth_country string,
    shoots_catches string, ingested_at timestamp
"""

RAW_PLAYER_STATS = """
    player_id bigint, season_id int, team_abbrev string, position string, games_played int,
    goals int, assists int, points int, plus_minus int, pp_goals int, pp_points int,
    sh_goals int, sh_points int, shots int, shooting_pct double, toi_per_game double,
    ingested_at timestamp
"""

RAW_XG_SHOTS = """
    game_id bigint, shooterPlayerId double, shooterName string, season int, team string,
    period int, time int, xCordAdjusted double, yCordAdjusted double, shotType string,
    event string, shotRush int, shotRebound int, isPlayoffGame int, xGoal double
"""

_TEXT = "struct<`default`: string>"

SCHEDULE_DOC = f"""
    doc_ts timestamp, schedule_date date,
    gameWeek array<struct<games: array<struct<
        id: bigint, season: int, gameType: int, gameState: string, startTimeUTC: string,
        venue: {_TEXT},
        homeTeam: struct<id: bigint, abbrev: string, score: int>,
        awayTeam: struct<id: bigint, abbrev: string, score: int>,
        gameOutcome: struct<lastPeriodType: string>>>>>
"""

# Plays stay text at this level, so that each play's payload can be kept whole.
PLAYS_DOC = "doc_ts timestamp, id bigint, season int, plays array<string>"

PLAY = """
    eventId bigint, periodDescriptor struct<number: int>, timeInPeriod string,
    typeDescKey string, situationCode string, homeTeamDefendingSide string,
    details struct<scoringPlayerId: bigint, shootingPlayerId: bigint, xCoord: double,
        yCoord: double, shotType: string, goalieInNetId: bigint, eventOwnerTeamId: bigint,
        awayScore: int, homeScore: int, highlightClipSharingUrl: string>
"""

# What flattening reads of documents held as text: with the plays as text, and with the plays parsed.
PAYLOADS_DOC = "id bigint, season int, plays array<string>"
PARSED_PLAYS_DOC = f"id bigint, season int, plays array<struct<{PLAY}>>"

STANDINGS_DOC = f"doc_ts timestamp, standings array<struct<teamAbbrev: {_TEXT}>>"

_ROSTER_PLAYER = f"""array<struct<
    id: bigint, firstName: {_TEXT}, lastName: {_TEXT}, positionCode: string, headshot: string,
    sweaterNumber: int, heightInInches: int, weightInPounds: int, birthDate: string,
    birthCity: {_TEXT}, birthCountry: string, shootsCatches: string>>"""

ROSTER_DOC = f"""
    doc_ts timestamp, team_abbrev string, forwards {_ROSTER_PLAYER},
    defensemen {_ROSTER_PLAYER}, goalies {_ROSTER_PLAYER}
"""

SKATER_STATS_DOC = """
    doc_ts timestamp, season_id int,
    data array<struct<playerId: bigint, teamAbbrevs: string, positionCode: string,
        gamesPlayed: int, goals: int, assists: int, points: int, plusMinus: int, ppGoals: int,
        ppPoints: int, shGoals: int, shPoints: int, shots: int, shootingPct: double,
        timeOnIcePerGame: double>>
"""
