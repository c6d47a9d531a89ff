"""Table schemas of the game catalogue.

The landed table is what ingest appends to Parquet; the analysis table is the
subset every analysis reads (free-text and URL columns left out).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: landed column names and types, in table order ----------
LANDED_COLUMNS: list[tuple[str, T.DataType]] = [
    ("appID", T.StringType()),
    ("name", T.StringType()),
    ("releaseDate", T.StringType()),
    ("estimatedOwners", T.StringType()),
    ("peakCCU", T.IntegerType()),
    ("requiredAge", T.IntegerType()),
    ("price", T.FloatType()),
    ("dlcCount", T.IntegerType()),
    ("longDesc", T.StringType()),
    ("shortDesc", T.StringType()),
    ("languages", T.StringType()),
    ("fullAudioLanguages", T.StringType()),
    ("reviews", T.StringType()),
    ("headerImage", T.StringType()),
    ("website", T.StringType()),
    ("supportWeb", T.StringType()),
    ("supportEmail", T.StringType()),
    ("supportWindows", T.BooleanType()),
    ("supportMac", T.BooleanType()),
    ("supportLinux", T.BooleanType()),
    ("metacriticScore", T.IntegerType()),
    ("metacriticURL", T.StringType()),
    ("userScore", T.IntegerType()),
    ("positive", T.IntegerType()),
    ("negative", T.IntegerType()),
    ("scoreRank", T.StringType()),
    ("achievements", T.IntegerType()),
    ("recommendations", T.IntegerType()),
    ("notes", T.StringType()),
    ("averagePlaytime", T.IntegerType()),
    ("averagePlaytime2W", T.IntegerType()),
    ("medianPlaytime", T.IntegerType()),
    ("medianPlaytime2W", T.IntegerType()),
    ("packages", T.StringType()),
    ("developers", T.StringType()),
    ("publishers", T.StringType()),
    ("categories", T.StringType()),
    ("genres", T.StringType()),
    ("screenshots", T.StringType()),
    ("movies", T.StringType()),
    ("tags", T.StringType()),
]

# --- fixed values: landed columns the analysis table leaves out -----------
TEXT_ONLY_COLUMNS = [
    "longDesc", "shortDesc", "headerImage", "website", "supportWeb",
    "supportEmail", "metacriticURL", "notes", "screenshots", "movies",
]

LANDED_SCHEMA = T.StructType(
    [T.StructField(n, t, nullable=True) for n, t in LANDED_COLUMNS])

ANALYSIS_SCHEMA = T.StructType(
    [f for f in LANDED_SCHEMA.fields if f.name not in TEXT_ONLY_COLUMNS])

ANALYSIS_COLUMNS = [f.name for f in ANALYSIS_SCHEMA.fields]


def numeric_columns(schema: T.StructType) -> list[str]:
    """Columns of a numeric type, in schema order (R2)."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]
