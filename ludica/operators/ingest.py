"""Message decoding and field mapping (M1-M8) as column expressions.

Works the same on a batch or a streaming DataFrame with a ``value STRING``
column (Kafka value, text file line). Messages are parsed to VARIANT (binary
JSON); one cast takes a record apart into a struct with a VARIANT field for
each key that is asked for, so a column is a field access and not a look-up. A field
tells a missing key (NULL) from a JSON null (variant null). No per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludica.schema import LANDED_SCHEMA

# --- fixed values: source record keys -> landed column names, in source order
RENAMES: list[tuple[str, str]] = [
    ("AppID", "appID"),
    ("Name", "name"),
    ("Release date", "releaseDate"),
    ("Estimated owners", "estimatedOwners"),
    ("Peak CCU", "peakCCU"),
    ("Required age", "requiredAge"),
    ("Price", "price"),
    ("DLC count", "dlcCount"),
    ("About the game", "longDesc"),
    ("Game Features", "shortDesc"),
    ("Supported languages", "languages"),
    ("Full audio languages", "fullAudioLanguages"),
    ("Reviews", "reviews"),
    ("Header image", "headerImage"),
    ("Website", "website"),
    ("Support url", "supportWeb"),
    ("Support email", "supportEmail"),
    ("Windows", "supportWindows"),
    ("Mac", "supportMac"),
    ("Linux", "supportLinux"),
    ("Metacritic score", "metacriticScore"),
    ("Metacritic url", "metacriticURL"),
    ("User score", "userScore"),
    ("Positive", "positive"),
    ("Negative", "negative"),
    ("Score rank", "scoreRank"),
    ("Achievements", "achievements"),
    ("Recommendations", "recommendations"),
    ("Notes", "notes"),
    ("Average playtime forever", "averagePlaytime"),
    ("Average playtime two weeks", "averagePlaytime2W"),
    ("Median playtime forever", "medianPlaytime"),
    ("Median playtime two weeks", "medianPlaytime2W"),
    ("Developers", "developers"),
    ("Publishers", "publishers"),
    ("Categories", "categories"),
    ("Genres", "genres"),
    ("Screenshots", "screenshots"),
    ("Movies", "movies"),
    ("Tags", "tags"),
]
ENVELOPE_KEY = "data"
CLOSE_SENTINEL = "close"

SOURCE_OF = {dst: src for src, dst in RENAMES}

RECORD = "_record"     # struct of variants, one for each of RECORD_KEYS
DOTTED = "_dotted"     # the record's text may hold an unquoted number with a point
#: Keys that are read from a record: the source keys, then those spelled like a column.
RECORD_KEYS = list(dict.fromkeys([src for src, _ in RENAMES] + [f.name for f in LANDED_SCHEMA.fields]))
# a cast by name takes the record apart; keys that differ by case alone need names of their own afterwards
_BY_KEY = "struct<" + ", ".join(f"`{k}`: variant" for k in RECORD_KEYS) + ">"
_BY_PLACE = "struct<" + ", ".join(f"k{i}: variant" for i in range(len(RECORD_KEYS))) + ">"


def _coerced(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.IntegerType, T.FloatType, T.BooleanType))


COERCED_SOURCE_KEYS = [SOURCE_OF[f.name] for f in LANDED_SCHEMA.fields
                       if f.name in SOURCE_OF and _coerced(f.dataType)]


# ------------------------------------------------------------ scalar rules

def to_int_or_zero(v: Column) -> Column:
    """M4: optional sign and ASCII digits within int range, else 0. (Digits of
    other scripts, which the JVM's parser would take, count as unparseable.)"""
    ok = v.rlike(r"\A[+-]?[0-9]+\z")
    return F.coalesce(F.when(ok, v.try_cast("int")), F.lit(0))


# The JVM's float syntax - white space up to U+0020 around an
# optional sign and a decimal or hexadecimal number with optional f/d suffix.
_FLOAT_TEXT = (r"\A[\x00-\x20]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
               r"|0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?[\x00-\x20]*\z")
_SPECIAL_TEXT = r"\A[\x00-\x20]*([+-]?)(NaN|Infinity)[\x00-\x20]*\z"


def to_float_or_zero(v: Column) -> Column:
    """M5: float text (spaces, exponent, f/d suffix; NaN and Infinity only as
    spelled here), else 0.0."""
    special = F.concat(F.when(F.regexp_extract(v, _SPECIAL_TEXT, 1) == "-", F.lit("-")).otherwise(F.lit("")),
                       F.regexp_extract(v, _SPECIAL_TEXT, 2))
    value = (F.when(v.rlike(_FLOAT_TEXT), java_trim(v).try_cast("float"))
             .when(v.rlike(_SPECIAL_TEXT), F.regexp_replace(special, "^-NaN$", "NaN").try_cast("float")))
    return F.coalesce(value, F.lit(0.0).cast("float"))


def to_bool_or_false(v: Column) -> Column:
    """M6: 'true' in any case is true; anything else is false."""
    return F.coalesce(F.lower(v) == F.lit("true"), F.lit(False))


_JAVA_WHITESPACE = "".join(chr(i) for i in range(0x21))


def java_trim(c: Column) -> Column:
    """Strip leading/trailing characters <= U+0020 (Java ``String.trim``)."""
    return F.trim(c, F.lit(_JAVA_WHITESPACE))


# ------------------------------------------------------------------ M1 / M2

def _keep_rows(df: DataFrame, keep: Column, cols: list[Column], passthrough: list[str]) -> DataFrame:
    """Rows where ``keep`` holds, projected to ``cols``.

    A plain ``where`` on columns computed from ``from_json`` is pushed below
    the projection with the parse inlined into every predicate term. Instead
    the columns and the ``keep`` flag are computed in one codegen'd
    projection (subexpression elimination parses each message once), and a
    Generate over those attributes drops the rows: ``inline(NULL)`` yields
    no row, and predicates are not pushed through a Generate.
    """
    proj = df.select(*passthrough, keep.alias("_keep"), *cols)
    names = [c for c in proj.columns if c not in passthrough and c != "_keep"]
    return proj.select(*passthrough,
                       F.inline(F.when(F.col("_keep"), F.array(F.struct(*names)))))


def decode_messages(msgs: DataFrame, value: str = "value", malformed: str = "null_row",
                    keep_raw: bool = False) -> DataFrame:
    """M1 + M2: envelope ``{"data": "<json text>"}`` -> parsed record (RECORD).

    Kept: messages whose outer JSON is an object with a non-NULL ``data``.
    Dropped: invalid outer JSON, missing or NULL ``data``, inner literal
    ``null``, and the ``close`` sentinel (see ``is_close``). Inner text that
    is not a JSON object becomes a record without keys (one all-NULL row) under
    ``malformed='null_row'``, is dropped under ``'drop'``, and is marked in
    ``_malformed`` under ``'quarantine'`` (rows kept with their raw text).
    """
    if malformed not in ("null_row", "drop", "quarantine"):
        raise ValueError(f"unknown malformed policy {malformed!r}")
    _last_of_repeated_keys(msgs)
    inner = _envelope_text(value)
    # not a JSON object: NULL, and then every key is missing
    record = F.try_variant_get(F.try_parse_json(inner), "$", _BY_KEY).cast(_BY_PLACE)
    keep = (inner.isNotNull() & (inner != F.lit(CLOSE_SENTINEL))
            & ~inner.rlike(r"(?s)^[\x00-\x20]*null([\x00-\x20].*)?$"))
    bad = record.isNull()
    if malformed == "drop":
        keep = keep & ~bad
    cols = [record.alias(RECORD), inner.rlike(r":[\x00-\x20]*-?[0-9]+\.").alias(DOTTED)]
    if malformed == "quarantine":
        cols.append(bad.alias("_malformed"))
    if keep_raw or malformed == "quarantine":
        cols.append(inner.alias("_inner"))
    return _keep_rows(msgs, keep, cols, msgs.columns)


def is_close(value: str = "value") -> Column:
    """M2: the message is the ``{"data": "close"}`` sentinel."""
    return F.coalesce(_envelope_text(value) == F.lit(CLOSE_SENTINEL), F.lit(False))


def _envelope_text(value: str) -> Column:
    """The envelope's text (a record that is no string as its JSON); NULL if
    there is none, it is a JSON null, or the envelope is no JSON object."""
    return F.try_variant_get(F.try_parse_json(F.col(value)), f"$.{ENVELOPE_KEY}", "string")


def _last_of_repeated_keys(df: DataFrame) -> None:
    """Of repeated keys the last one counts, as in most JSON readers; by default
    Spark takes such an object for malformed."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


# ------------------------------------------------------------------ M3-M8

def _field(key: str) -> Column:
    """The value of ``key``: NULL if it is missing, a variant null if it is a JSON null."""
    return F.col(f"{RECORD}.k{RECORD_KEYS.index(key)}")


def _text(value: Column) -> Column:
    """A string as it is, other JSON as its text (numbers as Spark writes them), null as NULL."""
    return value.cast("string")


def _coerce(dtype: T.DataType, value: Column) -> Column:
    if isinstance(dtype, T.IntegerType):
        # an unquoted 5.0 is no integer text, but as a variant it is written like one
        decimal = F.col(DOTTED) & F.schema_of_variant(value).startswith("DECIMAL")
        return F.when(decimal, F.lit(0)).otherwise(to_int_or_zero(_text(value)))
    if isinstance(dtype, T.FloatType):
        return to_float_or_zero(_text(value))
    if isinstance(dtype, T.BooleanType):
        return to_bool_or_false(_text(value))
    return _text(value)


def null_poisoned() -> Column:
    """M7: a coercing source key is present with a JSON null."""
    cond = F.lit(False)
    for k in COERCED_SOURCE_KEYS:
        cond = cond | F.is_variant_null(_field(k))
    return cond


def mapped_column(field: T.StructField) -> Column:
    """M3-M6 + M8 for one landed column.

    The renamed source key wins and is coerced (unparseable -> 0/0.0/false);
    otherwise a key already spelled like the column passes through, cast
    with ``try_cast`` (NULL when unparseable); a missing key is NULL.
    """
    name, dtype = field.name, field.dataType
    direct = _text(_field(name))
    if not isinstance(dtype, T.StringType):
        direct = direct.try_cast(dtype)
    src = SOURCE_OF.get(name)
    if src is None:
        return direct.alias(name)
    value = _field(src)
    return F.when(value.isNotNull(), _coerce(dtype, value)).otherwise(direct).cast(dtype).alias(name)


def map_game_fields(decoded: DataFrame, schema: T.StructType = LANDED_SCHEMA,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """M3-M8: decoded records -> rows of ``schema`` (null-poisoned dropped)."""
    return _keep_rows(decoded, ~null_poisoned(), [mapped_column(f) for f in schema.fields],
                      list(keep))


def messages_to_rows(msgs: DataFrame, value: str = "value",
                     malformed: str = "null_row") -> DataFrame:
    """M1-M8 in one plan: message text -> landed rows."""
    return map_game_fields(decode_messages(msgs, value, malformed))


def quarantine_split(msgs: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """M1 ``quarantine`` policy as two outputs: (landed rows, quarantined
    messages with their raw inner text). Both come from one decode."""
    decoded = decode_messages(msgs, value, malformed="quarantine")
    good = map_game_fields(decoded.where(~F.col("_malformed")))
    bad = decoded.where(F.col("_malformed")).select(F.col(value).alias("raw_message"),
                                                    F.col("_inner").alias("raw_record"))
    return good, bad
