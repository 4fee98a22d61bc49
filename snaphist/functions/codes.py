"""Code tables and the expressions that apply them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Position codes that are written another way.
POSITION_ALIASES = {"L": "LW", "R": "RW"}

# Which positions form which position group.
POSITION_GROUPS = {
    "Forward": ["C", "LW", "RW", "F", "RW/C"],
    "Defenseman": ["D"],
    "Goalie": ["G"],
}
UNKNOWN_GROUP = "Unknown"

# Document sections and the position group each one stands for.
SECTIONS = {"forwards": "Forward", "defensemen": "Defenseman", "goalies": "Goalie"}

# Lineage and link texts of the reference data set.
DEFAULT_SOURCE = "nhl-api"
MEMBER_URL_PREFIX = "https://www.nhl.com/player/"

# Display names of the group codes tracked by default.
GROUP_NAMES = {
    "ANA": "Anaheim Ducks",
    "BOS": "Boston Bruins",
    "BUF": "Buffalo Sabres",
    "CAR": "Carolina Hurricanes",
    "CGY": "Calgary Flames",
    "CHI": "Chicago Blackhawks",
    "COL": "Colorado Avalanche",
    "CBJ": "Columbus Blue Jackets",
    "DAL": "Dallas Stars",
    "DET": "Detroit Red Wings",
    "EDM": "Edmonton Oilers",
    "FLA": "Florida Panthers",
    "LAK": "Los Angeles Kings",
    "MIN": "Minnesota Wild",
    "MTL": "Montreal Canadiens",
    "NSH": "Nashville Predators",
    "NJD": "New Jersey Devils",
    "NYI": "New York Islanders",
    "NYR": "New York Rangers",
    "OTT": "Ottawa Senators",
    "PHI": "Philadelphia Flyers",
    "PIT": "Pittsburgh Penguins",
    "SJS": "San Jose Sharks",
    "SEA": "Seattle Kraken",
    "STL": "St. Louis Blues",
    "TBL": "Tampa Bay Lightning",
    "TOR": "Toronto Maple Leafs",
    "UTA": "Utah Hockey Club",
    "VAN": "Vancouver Canucks",
    "VGK": "Vegas Golden Knights",
    "WPG": "Winnipeg Jets",
    "WSH": "Washington Capitals",
}


def normalize_code(code: Column, aliases: dict[str, str]) -> Column:
    """Replace codes that have an alias; every other code passes through."""
    pairs = [F.lit(text) for pair in aliases.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[code], code)


def bucket_code(code: Column, buckets: dict[str, list[str]], default: str) -> Column:
    """Name of the bucket that lists ``code``, else ``default`` (also for NULL)."""
    branches = None
    for name, codes in buckets.items():
        branch = code.isin(codes)
        branches = (
            F.when(branch, F.lit(name)) if branches is None else branches.when(branch, F.lit(name))
        )
    return branches.otherwise(F.lit(default))


def position_group(position: Column) -> Column:
    return bucket_code(position, POSITION_GROUPS, UNKNOWN_GROUP)


def code_table(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """A (code, name) lookup table from a fixed mapping."""
    return spark.createDataFrame(list(names.items()), "code STRING, name STRING")


def with_code_name(df: DataFrame, code: str, lookup: DataFrame, name: str) -> DataFrame:
    """Add the display name of ``code``, or the code itself where the lookup has none.

    ``lookup`` has columns (code, name) and one row per code. No broadcast is forced:
    a lookup below the session's threshold is broadcast by Spark, a larger one joins
    by shuffle.
    """
    names = lookup.select(F.col("code").alias("_code"), F.col("name").alias("_name"))
    return (
        df.join(names, F.col(code) == F.col("_code"), "left")
        .withColumn(name, F.coalesce("_name", F.col(code).cast("string")))
        .drop("_code", "_name")
    )
