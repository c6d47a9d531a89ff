"""Column expressions for the analysis features.

Everything is a built-in Catalyst expression, so it stays inside
whole-stage codegen. Under ANSI mode plain ``/``, int overflow and bad casts
raise; the original analysis (Spark 3.5, non-ANSI) got NULL or wrap-around instead,
so ``try_divide``/``try_cast`` and widening keep its results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: thresholds, labels and weights of the analyses ---------
SENTIMENT_POSITIVE_ABOVE = 0.6
SENTIMENT_NEUTRAL_FROM = 0.4
POPULARITY_WEIGHTS = (0.4, 0.3, 0.3)      # owners, userScore, totalPlaytime
POPULARITY_LABEL_BOUNDS = (100, 1000)     # peakCCU < 100: 0, < 1000: 1, else 2
POPULARITY_LABEL_NAMES = ["Low", "Medium", "High"]
METACRITIC_HIGH_ABOVE = 75
PLATFORM_LABELS = ("All Platforms", "Windows & Mac", "Windows & Linux", "Windows Only", "Mac Only", "Linux Only", "Unknown")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentiment_ratio(pos: str | Column = "positive", neg: str | Column = "negative") -> Column:
    """pos / (pos + neg) as DOUBLE; NULL for 0/0 or a NULL input."""
    p, n = _c(pos).cast("double"), _c(neg).cast("double")
    return F.try_divide(p, p + n)


def sentiment_category(ratio: Column) -> Column:
    """>0.6 Positive, >=0.4 Neutral, else (NULL included) Negative."""
    return (F.when(ratio > SENTIMENT_POSITIVE_ABOVE, "Positive")
            .when(ratio >= SENTIMENT_NEUTRAL_FROM, "Neutral")
            .otherwise("Negative"))


def with_sentiment(df: DataFrame, pos: str = "positive", neg: str = "negative",
                   method: str = "ratio") -> DataFrame:
    """F1 (ratio, what the analysis code does) / F1b (difference, README text)."""
    if method == "ratio":
        return (df.withColumn("sentimentRatio", sentiment_ratio(pos, neg))
                  .withColumn("sentimentCategory", sentiment_category(F.col("sentimentRatio"))))
    if method == "difference":
        score = _c(pos).cast("long") - _c(neg).cast("long")
        return (df.withColumn("sentimentScore", score)
                  .withColumn("sentimentCategory",
                              F.when(F.col("sentimentScore") > 0, "Positive")
                               .when(F.col("sentimentScore") == 0, "Neutral")
                               .otherwise("Negative")))
    raise ValueError(f"unknown sentiment method {method!r}")


def total_playtime(a: str | Column = "averagePlaytime",
                   b: str | Column = "averagePlaytime2W") -> Column:
    """widened to BIGINT so the sum cannot overflow under ANSI."""
    return _c(a).cast("long") + _c(b).cast("long")


def owners_num(owners: str | Column = "estimatedOwners") -> Column:
    """first digit run as INT ("0 - 20000" -> 0); none or too long -> NULL."""
    digits = F.regexp_extract(_c(owners), r"(\d+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def popularity_score(owners: Column, user_score: Column, playtime: Column) -> Column:
    """0.4 owners + 0.3 userScore + 0.3 totalPlaytime in DOUBLE."""
    w_o, w_u, w_p = POPULARITY_WEIGHTS
    return (owners.cast("double") * F.lit(w_o) + user_score.cast("double") * F.lit(w_u)
            + playtime.cast("double") * F.lit(w_p))


def with_popularity(df: DataFrame) -> DataFrame:
    """F1 + F2 + F3 + F4 in one projection (the popularity analysis inputs)."""
    return (with_sentiment(df)
            .withColumn("totalPlaytime", total_playtime())
            .withColumn("estimatedOwnersNum", owners_num())
            .withColumn("popularityScore",
                        popularity_score(F.col("estimatedOwnersNum"), F.col("userScore"),
                                         F.col("totalPlaytime"))))


def platform(win: str = "supportWindows", mac: str = "supportMac",
             lin: str = "supportLinux") -> Column:
    """first matching label; NULL flags count as false; Mac wins over Linux."""
    w, m, lx = (F.coalesce(_c(win), F.lit(False)), F.coalesce(_c(mac), F.lit(False)),
                F.coalesce(_c(lin), F.lit(False)))
    conditions = (w & m & lx, w & m, w & lx, w, m, lx)
    label = F.lit(PLATFORM_LABELS[-1])
    for condition, name in reversed(tuple(zip(conditions, PLATFORM_LABELS))):
        label = F.when(condition, name).otherwise(label)
    return label


def game_type(genres: str | Column = "genres") -> Column:
    """Action if the genres mention action, else Strategy, else NULL."""
    g = F.lower(_c(genres))
    return (F.when(g.contains("action"), "Action")
            .when(g.contains("strategy"), "Strategy")
            .otherwise(F.lit(None).cast("string")))


def popularity_label(peak: str | Column = "peakCCU") -> Column:
    """0 below 100 peak users, 1 below 1000, else 2."""
    lo, hi = POPULARITY_LABEL_BOUNDS
    p = _c(peak)
    return F.when(p < lo, 0).when((p >= lo) & (p < hi), 1).otherwise(2)


def with_platform(df: DataFrame) -> DataFrame:
    return df.withColumn("platform", platform())


def with_game_type(df: DataFrame) -> DataFrame:
    return df.withColumn("gameType", game_type())
