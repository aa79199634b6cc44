"""Keys and display labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotmarts.functions.numeric import round_half_even

# Text standing for a missing key part, missing-text mark, logo address,
# score and rank thresholds.
MISSING_KEY_PART = "_dbt_utils_surrogate_key_null_"
MISSING = "—"
LOGO_PREFIX = "https://assets.nhle.com/logos/nhl/svg/"
LOGO_SUFFIX = "_light.svg"
SCORE_HIGH, SCORE_MEDIUM = 67, 34
RANK_TOP, RANK_MIDDLE = 0.33, 0.67

# Club abbreviation to name.
TEAM_NAMES = {
    "ANA": "Anaheim Ducks",
    "BOS": "Boston Bruins",
    "BUF": "Buffalo Sabres",
    "CAR": "Carolina Hurricanes",
    "CBJ": "Columbus Blue Jackets",
    "CGY": "Calgary Flames",
    "CHI": "Chicago Blackhawks",
    "COL": "Colorado Avalanche",
    "DAL": "Dallas Stars",
    "DET": "Detroit Red Wings",
    "EDM": "Edmonton Oilers",
    "FLA": "Florida Panthers",
    "LAK": "Los Angeles Kings",
    "MIN": "Minnesota Wild",
    "MTL": "Montréal Canadiens",
    "NJD": "New Jersey Devils",
    "NSH": "Nashville Predators",
    "NYI": "New York Islanders",
    "NYR": "New York Rangers",
    "OTT": "Ottawa Senators",
    "PHI": "Philadelphia Flyers",
    "PIT": "Pittsburgh Penguins",
    "SEA": "Seattle Kraken",
    "SJS": "San Jose Sharks",
    "STL": "St. Louis Blues",
    "TBL": "Tampa Bay Lightning",
    "TOR": "Toronto Maple Leafs",
    "UTA": "Utah Mammoth",
    "VAN": "Vancouver Canucks",
    "VGK": "Vegas Golden Knights",
    "WSH": "Washington Capitals",
    "WPG": "Winnipeg Jets",
}


def surrogate_key(*parts: Column) -> Column:
    """md5 of the parts as text joined with ``-``; a NULL part has its own placeholder."""
    return F.md5(
        F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(MISSING_KEY_PART)) for p in parts])
    )


def season_label(season: Column) -> Column:
    """``20242025`` to ``2024-2025``."""
    text = season.cast("string")
    return F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 4))


def team_logo_url(abbrev: Column) -> Column:
    return F.concat(F.lit(LOGO_PREFIX), abbrev, F.lit(LOGO_SUFFIX))


def safe_date(text: Column) -> Column:
    """Date from ``YYYY-MM-DD``; anything else, a bare year included, gives NULL."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("date"))


def short_date(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "MMM dd"), F.lit(MISSING))


def opponent_label(is_home: Column, opponent: Column) -> Column:
    """``vs X`` at home, ``at X`` away; a shot with no game in the log reads ``vs —``."""
    venue = F.when(F.coalesce(is_home, F.lit(True)), "vs ").otherwise("at ")
    return F.concat(venue, F.coalesce(opponent, F.lit(MISSING)))


def percentile_score(percentile: Column) -> Column:
    """Percentile in [0, 1] to a whole score out of 100; missing is 0."""
    return round_half_even(F.coalesce(percentile, F.lit(0.0)) * 100, 0).cast("bigint")


def score_tier(score: Column) -> Column:
    return (
        F.when(score >= SCORE_HIGH, "high").when(score >= SCORE_MEDIUM, "medium").otherwise("low")
    )


def rank_tier(rank: Column, size: Column) -> Column:
    """Third of the table a rank falls in; NULL for an unranked row."""
    share = rank.cast("double") / size.cast("double")
    return F.when(
        rank.isNotNull(),
        F.when(share <= RANK_TOP, "top").when(share <= RANK_MIDDLE, "middle").otherwise("bottom"),
    )


def ordinal(rank: Column) -> Column:
    """``1st``, ``2nd``, ``3rd``, ``4th``; ``—`` for an unranked row."""
    last = F.when(rank < 20, rank).otherwise(rank % 10)
    suffix = F.when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.coalesce(F.concat(rank.cast("string"), suffix), F.lit(MISSING))


def height_label(inches: Column) -> Column:
    """Inches to feet and inches, e.g. ``6'2"``."""
    feet = ((inches - inches % 12) / 12).cast("int").cast("string")
    return F.concat(feet, F.lit("'"), (inches % 12).cast("string"), F.lit('"'))


def clip_content_id(url: Column) -> Column:
    """Last ``-`` separated part of a clip address, trailing slashes removed."""
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "-"), -1)


def club_names(spark) -> DataFrame:
    """The fixed club names as a dimension (team_abbrev, name): 32 rows."""
    return spark.createDataFrame(sorted(TEAM_NAMES.items()), "team_abbrev string, name string")
