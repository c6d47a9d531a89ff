"""Named analyses: each takes (spark, sf_dir) and returns a lazy DataFrame.

These compose the operators over the catalogue derived from the driver
tables (``ludica.sources.games``). Computed numbers are DOUBLE rounded to 6
decimals so the DuckDB oracle (``ludica.plans.oracle``) can compare hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludica.functions import features as feat
from ludica.operators import aggregate as agg
from ludica.operators import clean
from ludica.operators import charts, comoments, correlation, ingest, ml, sketches, stats, trees
from ludica.session import scratch_path
from ludica.sources import messages
from ludica.streaming import pipeline
from ludica.schema import ANALYSIS_SCHEMA, numeric_columns
from ludica.sources.games import deduped_games, games, raw_games, register_views
from ludica.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def r6(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


# ------------------------------------------------------------- popularity

def popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The popularity table: sentiment, playtime, owners, score per game."""
    return feat.with_popularity(games(spark, sf_dir)).select(
        "appID", "name", "estimatedOwners", "userScore", "totalPlaytime",
        "popularityScore", "sentimentCategory")


@query
def popularity_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 / V7: the ten most popular games (F1-F4 score)."""
    top = agg.top_k(popularity(spark, sf_dir), "popularityScore", 10, tie_break="appID")
    return top.select("appID", "name", r6("popularityScore").alias("popularityScore"))


@query
def popularity_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the whole popularity table, best first (ties by appID)."""
    ranked = agg.sort_desc(popularity(spark, sf_dir), "popularityScore", tie_break="appID")
    return ranked.withColumn("popularityScore", r6("popularityScore"))


@query
def sentiment_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """positive share of reviews and its category."""
    df = feat.with_sentiment(games(spark, sf_dir), method="ratio")
    return df.select("appID", "positive", "negative", r6("sentimentRatio").alias("sentimentRatio"),
                     "sentimentCategory")


@query
def sentiment_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive minus negative reviews and its category."""
    df = feat.with_sentiment(games(spark, sf_dir), method="difference")
    return df.select("appID", "positive", "negative", "sentimentScore", "sentimentCategory")


@query
def owners_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lower bound of the estimated-owners range as a number."""
    df = games(spark, sf_dir)
    return df.select("appID", "estimatedOwners", feat.owners_num().alias("estimatedOwnersNum"))


@query
def dedupe_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 before and after R1 in one shuffle: count copies per distinct row."""
    raw = raw_games(spark, sf_dir)
    copies = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_c"))
    return copies.agg(F.sum("_c").cast("long").alias("raw_rows"),
                      F.count(F.lit(1)).alias("distinct_rows"))


@query
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 on the landed rows: the deduplicated 31-column analysis table."""
    return deduped_games(spark, sf_dir)


def platform_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 + R4 + F5: the ANOVA input (name, price, averagePlaytime, platform)."""
    df = feat.with_platform(games(spark, sf_dir)).select("name", "price", "averagePlaytime", "platform")
    return clean.positive_filter(df, "price", "averagePlaytime")


def platform_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ANOVA input without the 'Mac Only' group."""
    return clean.exclude_value(platform_table(spark, sf_dir), "platform", "Mac Only")


@query
def platform_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 + F5: the ANOVA input (paid games with playtime, by platform)."""
    return platform_table(spark, sf_dir)


@query
def platform_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games per platform (Mac Only excluded), largest first."""
    return agg.group_counts(platform_groups(spark, sf_dir), "platform", "count")


def genre_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 + R5: (name, gameType, averagePlaytime) for Action / Strategy games."""
    df = feat.with_game_type(games(spark, sf_dir))
    return (df.where(F.col("gameType").isNotNull() & (F.col("averagePlaytime") > 0))
              .select("appID", "name", "gameType", "averagePlaytime"))


@query
def genre_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 + R5: Action / Strategy games with playtime."""
    return genre_table(spark, sf_dir).drop("appID")


def labeled_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R10 + F7: games with peak users, labelled 0/1/2."""
    df = clean.positive_filter(games(spark, sf_dir), "peakCCU")
    return df.withColumn("label", feat.popularity_label())


@query
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games per popularity label."""
    return agg.group_counts(labeled_games(spark, sf_dir), "label", "count")


@query
def split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded 80/20 split (seed 1234), counted per part and label."""
    df = labeled_games(spark, sf_dir)
    part = F.when(clean.in_fraction("appID", 0.8, 1234), "train").otherwise("test")
    return df.groupBy(part.alias("split"), "label").agg(F.count(F.lit(1)).alias("count"))


REGRESSION_INPUTS = ["recommendations", "positive", "negative", "peakCCU"]


def regression_rows(spark: SparkSession, sf_dir: str, fraction: float = 1.0) -> DataFrame:
    """R3 + R8 (and P1 below fraction 1): four int columns, listwise non-NULL."""
    df = clean.sample_fraction(games(spark, sf_dir), fraction, seed=42, key="appID")
    df = df.select("appID", *[F.col(c).cast("int").alias(c) for c in REGRESSION_INPUTS])
    return clean.drop_nulls(df, REGRESSION_INPUTS)


@query
def sample_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + R8: the seeded 10 % regression sample."""
    return regression_rows(spark, sf_dir, 0.1)


def playtime_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """averagePlaytime as DOUBLE, not NULL and > 0."""
    return clean.not_null_positive(games(spark, sf_dir), "averagePlaytime", cast="double")


@query
def iqr_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z1 (exact data-point quartiles) summarised: bounds and rows kept."""
    df = playtime_positive(spark, sf_dir)
    fence = clean.iqr_bounds(df, "averagePlaytime", method="exact")
    lit = lambda x: F.lit(x).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("n_in"),
        F.count(F.when(fence.column("averagePlaytime"), 1)).alias("n_kept"),
    ).select(r6(lit(fence.q_low)).alias("q1"), r6(lit(fence.q_high)).alias("q3"),
             r6(lit(fence.q_high - fence.q_low)).alias("iqr"),
             r6(lit(fence.lower)).alias("lower_bound"), r6(lit(fence.upper)).alias("upper_bound"),
             "n_in", "n_kept")


@query
def percentile_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANOVA rows between the 5th and 95th percentile of all groups."""
    trimmed, _ = clean.percentile_trim(platform_groups(spark, sf_dir), "averagePlaytime", 5, 95)
    return trimmed


# ------------------------------------------------------------ statistical tests

def _round_all(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every DOUBLE column to 6 decimals (hash-comparable output)."""
    return df.select(*[r6(f.name).alias(f.name) if f.dataType.simpleString() == "double"
                       and f.name not in keep else F.col(f.name) for f in df.schema.fields])


@query
def levene_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 statistic and degrees of freedom (median-centred)."""
    return _round_all(stats.levene(platform_groups(spark, sf_dir), "averagePlaytime", "platform",
                                   with_p=False))


@query
def levene_platform_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 with its p-value."""
    return stats.levene(platform_groups(spark, sf_dir), "averagePlaytime", "platform")


@query
def welch_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 statistic and degrees of freedom."""
    return _round_all(stats.welch_anova(platform_groups(spark, sf_dir), "averagePlaytime",
                                        "platform", with_p=False))


@query
def anova_platform_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 as the analysis reports it: F_statistic and P_value."""
    res = stats.welch_anova(platform_groups(spark, sf_dir), "averagePlaytime", "platform")
    return res.select("F_statistic", "P_value")


@query
def tukey_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 mean differences and studentized ranges per platform pair."""
    return _round_all(stats.tukey_hsd(platform_groups(spark, sf_dir), "averagePlaytime",
                                      "platform", with_p=False))


@query
def tukey_platform_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with adjusted p-values, confidence intervals and reject flags."""
    return stats.tukey_hsd(platform_groups(spark, sf_dir), "averagePlaytime", "platform")


@query
def tukey_platform_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 -> T3 as the analysis chains them: pairs only where the ANOVA rejects."""
    return stats.tukey_after_welch(platform_groups(spark, sf_dir), "averagePlaytime", "platform")


def _mw(spark: SparkSession, sf_dir: str, downsampled: bool, with_p: bool) -> DataFrame:
    g = genre_table(spark, sf_dir)
    if downsampled:
        action = g.where(F.col("gameType") == "Action")
        strategy = g.where(F.col("gameType") == "Strategy")
        n = strategy.count()
        g = clean.downsample(action, n, seed=42, key="appID").unionByName(strategy)
    res = stats.mann_whitney(g, "averagePlaytime", "gameType", "Action", "Strategy",
                             with_p=with_p)
    return res.withColumnRenamed("n_first", "n_action").withColumnRenamed("n_second", "n_strategy")


@query
def mannwhitney_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 on all Action vs all Strategy games: U (for Action), sizes, tie term."""
    return _round_all(_mw(spark, sf_dir, False, False))


@query
def mannwhitney_downsampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + T4: Action downsampled (seed 42) to the Strategy count, then U."""
    return _round_all(_mw(spark, sf_dir, True, False))


@query
def mann_whitney_genre_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 as the analysis reports it (downsampled): U_statistic and P_value."""
    return _mw(spark, sf_dir, True, True).select("U_statistic", "P_value")


def _ttest(spark: SparkSession, sf_dir: str, with_p: bool, method: str) -> DataFrame:
    df = playtime_positive(spark, sf_dir)
    cleaned, _ = clean.iqr_fence(df, "averagePlaytime", method=method)
    cond = F.col("metacriticScore") > feat.METACRITIC_HIGH_ABOVE
    return stats.welch_t_test(cleaned, "averagePlaytime", cond, with_p=with_p)


@query
def ttest_metacritic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z1 (exact quartiles) + G4 + T5: Welch t statistic and degrees of freedom."""
    return _round_all(_ttest(spark, sf_dir, False, "exact"))


@query
def ttest_metacritic_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + T6 with the approximate IQR fence of the analysis (error 0.01)."""
    return _ttest(spark, sf_dir, True, "approx")


# ------------------------------------------------------------------ chart data

def trimmed_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.percentile_trim(platform_groups(spark, sf_dir), "averagePlaytime", 5, 95)[0]


def trimmed_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.percentile_trim(genre_table(spark, sf_dir), "averagePlaytime", 5, 95)[0]


@query
def box_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z2 + V1 by platform."""
    return _round_all(charts.box_stats(trimmed_platforms(spark, sf_dir), "averagePlaytime",
                                       "platform"))


@query
def box_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z2 + V1 by game type."""
    return _round_all(charts.box_stats(trimmed_genres(spark, sf_dir), "averagePlaytime",
                                       "gameType"))


@query
def hist_platform_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z2 + V2: 30 common bins, counts per platform."""
    return _round_all(charts.histogram(trimmed_platforms(spark, sf_dir), "averagePlaytime",
                                       "platform", 30))


@query
def hist_genre_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z2 + V2: 50 common bins, counts per game type."""
    return _round_all(charts.histogram(trimmed_genres(spark, sf_dir), "averagePlaytime",
                                       "gameType", 50))


def _kde(df: DataFrame, group: str) -> DataFrame:
    k = charts.kde(df, "averagePlaytime", group, grid=200)
    return k.select(group, "grid_index", r6("x").alias("x"),
                    F.round("density", 9).alias("density"))


@query
def kde_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z2 + V3: density curve per game type on 200 grid points."""
    return _kde(trimmed_genres(spark, sf_dir), "gameType")


@query
def kde_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z2 + V3: density curve per platform on 200 grid points."""
    return _kde(trimmed_platforms(spark, sf_dir), "platform")


NUMERIC = numeric_columns(ANALYSIS_SCHEMA)


@query
def corr_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 long form: r for the 91 pairs of the 14 numeric columns (pairwise)."""
    c = correlation.corr_long(games(spark, sf_dir), NUMERIC)
    return c.select("feature_a", "feature_b", r6("r").alias("r"))


@query
def corr_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 wide form (the analysis' correlation table), listwise deletion."""
    return _round_all(correlation.corr_wide(games(spark, sf_dir), NUMERIC, listwise=True))


@query
def corr_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: heatmap annotations, r to 2 decimals."""
    c = correlation.corr_long(games(spark, sf_dir), NUMERIC)
    return c.select("feature_a", "feature_b", F.round(F.col("r"), 2).alias("r"))


# ----------------------------------------------------------------------- models

POLY_INPUTS = ["recommendations", "negative", "peakCCU"]
CLASSIFIER_INPUTS = ["price", "recommendations", "positive", "negative", "medianPlaytime"]


@query
def poly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + L3: degree-2 expansion of the regression inputs as columns."""
    return ml.poly_columns(regression_rows(spark, sf_dir), POLY_INPUTS, keep=["appID", "positive"])


def _regression(spark: SparkSession, sf_dir: str):
    rows = regression_rows(spark, sf_dir)
    data = ml.poly_expand(ml.assemble(rows, POLY_INPUTS)).select("poly_features", "positive")
    return ml.fit_regression(data, "poly_features", "positive"), data


@query
def regression_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 + L5: polynomial least squares fit and its training metrics."""
    model, _ = _regression(spark, sf_dir)
    return ml.regression_summary(model, spark)


@query
def regression_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real vs predicted positive reviews."""
    model, data = _regression(spark, sf_dir)
    return ml.predictions(model, data, "positive")


@query
def regression_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: axis bounds and identity-line ends of the prediction scatter."""
    model, data = _regression(spark, sf_dir)
    return charts.scatter_bounds(ml.predictions(model, data, "positive"), "real_positive",
                                 "prediction")


@query
def regression_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 points: (appID, real, predicted) of every game."""
    rows = regression_rows(spark, sf_dir)
    data = ml.poly_expand(ml.assemble(rows, POLY_INPUTS)).select("appID", "poly_features", "positive")
    model = ml.fit_regression(data, "poly_features", "positive")
    return model.transform(data).select("appID", F.col("positive").alias("real_positive"), "prediction")


@query
def regression_normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 checked by its defining property: every term of the fit has the same
    sum of products with the predictions as with the label."""
    rows = ml.poly_columns(regression_rows(spark, sf_dir), POLY_INPUTS, keep=["positive"])
    names = ml.poly_names(POLY_INPUTS)
    data = ml.assemble(rows, names, "terms")
    pred = ml.fit_regression(data, "terms", "positive").transform(data).withColumn("intercept", F.lit(1.0))
    terms = ["intercept", *names]
    y = F.col("positive").cast("double")
    sums = pred.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c) * y).alias(f"_y{i}") for i, c in enumerate(terms)],
                    *[F.sum(F.col(c) * F.col("prediction")).alias(f"_p{i}") for i, c in enumerate(terms)])
    each = [F.struct(F.lit(c).alias("term"), F.col("n"), F.col(f"_y{i}").alias("sum_xy"),
                     F.round(F.try_divide(F.col(f"_p{i}"), F.col(f"_y{i}")), 4).alias("ratio"))
            for i, c in enumerate(terms)]
    return sums.select(F.inline(F.array(*each)))


@query
def regression_collinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4, L5 from co-moments: a fit with a feature that another one determines, and its rank."""
    rows = _table(spark, sf_dir, "lineitem", "l_quantity", "l_discount", "l_extendedprice")
    rows = rows.withColumn("twice", 2 * F.col("l_quantity") + 1)
    fit = comoments.linear_fit(rows, ["l_quantity", "twice", "l_discount"], "l_extendedprice")
    return fit.withColumn("coefficient", F.round("coefficient", 3))


@query
def sketch_quantiles_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 from kept sketches: one for each ship date, written in two runs, merged by
    return flag; whether each quantile's rank lies within the stated error."""
    path = scratch_path(spark, "date-sketches")
    rows = _table(spark, sf_dir, "lineitem", "l_returnflag", "l_shipdate", "l_extendedprice")
    late = F.col("l_shipdate") >= F.lit("1995-01-01").cast("date")
    for part in (~late, late):
        (sketches.sketch_table(rows.where(part), "l_extendedprice", ["l_returnflag", "l_shipdate"])
         .write.mode("append").parquet(path))
    probs = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}
    found = sketches.sketch_quantiles(spark.read.parquet(path), list(probs.values()), list(probs), ["l_returnflag"])
    ranked = agg.attach_summary(rows, found, "l_returnflag").groupBy("l_returnflag", "n").agg(*[
        F.avg(F.when(cond, 1).otherwise(0)).alias(f"{name}_{side}") for name in probs
        for side, cond in (("below", F.col("l_extendedprice") < F.col(name)), ("upto", F.col("l_extendedprice") <= F.col(name)))])
    error = sketches.rank_error()
    return ranked.select("l_returnflag", "n", *[
        ((F.col(f"{name}_below") <= p + error) & (F.col(f"{name}_upto") >= p - error)).alias(f"{name}_within")
        for name, p in probs.items()])


@query
def hist_special_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 where some values are NaN or infinite: they are counted apart."""
    key = F.col("p_partkey")
    price = F.when(key % 50 == 0, F.lit(float("nan"))).when(key % 50 == 1, F.lit(float("inf"))).when(
        key % 50 == 2, F.lit(float("-inf"))).otherwise(F.col("p_retailprice").cast("double"))
    rows = read_table(spark, sf_dir, "part").select("p_brand", price.alias("price"))
    return charts.histogram(rows, "price", "p_brand", 10).select("p_brand", "bin", "count")


@query
def corr_no_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 on a table that a filter leaves without rows: the features with NULL correlations."""
    rows = _table(spark, sf_dir, "lineitem", "l_quantity", "l_discount", "l_tax").where(F.col("l_quantity") < 0)
    return correlation.corr_wide(rows, ["l_quantity", "l_discount", "l_tax"])


def classifier_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """L1 + P2: labelled feature vectors, seeded 80/20 train/test split."""
    df = ml.assemble(labeled_games(spark, sf_dir), CLASSIFIER_INPUTS).select(
        "appID", "features", "label")
    return clean.split(df, 0.8, seed=1234, key="appID")


@query
def tree_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 + L9: decision tree test accuracy."""
    train, test = classifier_split(spark, sf_dir)
    return ml.accuracy(ml.fit_tree(train).transform(test))


@query
def tree_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learned tree (depth, nodes, readable form)."""
    train, _ = classifier_split(spark, sf_dir)
    m = ml.fit_tree(train)
    return spark.createDataFrame([(m.depth, m.numNodes, m.toDebugString)],
                                 "depth int, num_nodes int, tree string")


@query
def trees_as_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree and a forest as node tables, walked by joins: test rows by
    model and label, how many get the model's own prediction, and whether the votes are the trees' class shares."""
    train, test = classifier_split(spark, sf_dir)
    rows = labeled_games(spark, sf_dir)
    out = None
    for name, model in (("tree", ml.fit_tree(train)), ("forest", ml.fit_forest(train, num_trees=20))):
        own = model.transform(test).select("appID", "label", F.col("prediction").alias("said"))
        found = trees.evaluate(rows.join(test.select("appID"), "appID", "left_semi"), trees.node_table(spark, model),
                               CLASSIFIER_INPUTS, "appID")
        size = F.aggregate("votes", F.lit(0.0), lambda a, x: a + x)
        part = (own.join(found, "appID").groupBy(F.lit(name).alias("model"), "label").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("said") == F.col("prediction")).alias("n_agree"),
            F.round(F.max(size), 6).alias("votes")))
        out = part if out is None else out.unionByName(part)
    return out


def _forest(spark: SparkSession, sf_dir: str):
    train, test = classifier_split(spark, sf_dir)
    model = ml.fit_forest(train, num_trees=20)
    return model, model.transform(test)


@query
def forest_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 + L9: random forest (20 trees) test accuracy."""
    _, pred = _forest(spark, sf_dir)
    return ml.accuracy(pred)


@query
def forest_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature importances of the forest."""
    model, _ = _forest(spark, sf_dir)
    return ml.importances(model, CLASSIFIER_INPUTS, spark)


@query
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest confusion matrix over Low / Medium / High."""
    _, pred = _forest(spark, sf_dir)
    return ml.confusion(pred, [0, 1, 2], feat.POPULARITY_LABEL_NAMES)


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled games with a prediction made by a rule, which never says Medium."""
    return labeled_games(spark, sf_dir).withColumn(
        "prediction", F.when(F.coalesce(F.col("positive"), F.lit(0)) > F.coalesce(F.col("negative"), F.lit(0)), 2.0)
        .otherwise(0.0))


@query
def accuracy_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L9 on given predictions."""
    return _round_all(ml.accuracy(rule_predictions(spark, sf_dir)))


@query
def confusion_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 on given predictions, one class of which is never predicted."""
    return ml.confusion(rule_predictions(spark, sf_dir), [0, 1, 2], feat.POPULARITY_LABEL_NAMES)


@query
def split_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 where every sixth key is NULL: each row is in exactly one part."""
    df = games(spark, sf_dir).select(F.when(F.col("appID").cast("long") % 6 != 0, F.col("appID")).alias("appID"))
    a, b = clean.split(df, 0.8, seed=1234, key="appID")
    count = lambda part, name: part.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"),
                                        F.count_if(F.col("appID").isNull()).alias("null_keys"))
    return count(a, "train").unionByName(count(b, "test"))


# ----------------------------------------------------------------------- ingest

def catalog_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 over event-stream lines derived from the landed catalogue rows,
    re-deliveries included (ingest lands everything; analyses dedupe)."""
    return messages.sse_to_messages(messages.catalog_to_sse_lines(raw_games(spark, sf_dir)))


@query
def sse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-stream lines -> envelope messages."""
    return catalog_messages(spark, sf_dir)


@query
def ingest_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M8: envelope messages -> 41-column landed rows (batch plan)."""
    return ingest.messages_to_rows(catalog_messages(spark, sf_dir))


@query
def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 -> M1-M8 -> S5 as a Structured Streaming run (availableNow) over
    message files written from the catalogue; returns the landed table."""
    src_dir, out = scratch_path(spark, "messages"), scratch_path(spark, "landed")
    catalog_messages(spark, sf_dir).write.text(src_dir)
    pipeline.ingest_stream(messages.read_message_files(spark, src_dir, streaming=True), out).awaitTermination()
    return pipeline.load_landed(spark, out)


@query
def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 run twice into one folder, with more message files the second time:
    the second run appends what is new."""
    src_dir, out = scratch_path(spark, "messages"), scratch_path(spark, "landed")
    texts = catalog_messages(spark, sf_dir)
    for part in (0, 1):
        texts.where(F.pmod(F.xxhash64("value"), F.lit(2)) == part).write.mode("append").text(src_dir)
        pipeline.ingest_stream(messages.read_message_files(spark, src_dir, streaming=True), out).awaitTermination()
    return pipeline.load_landed(spark, out)


def _malformed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which most are malformed in some way, the close sentinel among them."""
    key = F.col("p_partkey")
    record = lambda field, text: F.concat(F.lit('{"AppID":"'), key.cast("string"), F.lit(f'","{field}":{text}}}'))
    inner = [F.lit("no json"), F.lit("null"), record("Price", "null"), F.lit("close"), None, None,
             record("Positive", '"5\\n"'), record("Price", '"inf"'), record("Price", '"nan"'), record("Price", '"Infinity"'),
             record("Price", '"NaN"'), record("Price", '" 1.5f "'), record("Positive", '"+7"'), record("Positive", '"1e3"')]
    value = F.when(key % len(inner) == 4, F.lit('{"other":"x"}')).when(key % len(inner) == 5, F.lit("{oops"))
    for k, text in enumerate(inner):
        if text is not None:
            value = value.when(key % len(inner) == k, F.to_json(F.struct(text.alias("data"))))
    return read_table(spark, sf_dir, "part").select(value.alias("value"))


@query
def ingest_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M4, M5, M7 on messages of which most are malformed in some way."""
    return _special_prices(ingest.messages_to_rows(_malformed_messages(spark, sf_dir)))


def _special_prices(rows: DataFrame) -> DataFrame:
    price = F.col("price")
    finite = ~F.isnan(price) & (F.abs(price) != float("inf"))
    return rows.select("appID", "positive", F.when(finite, price.cast("double")).alias("price"),
                       F.when(F.isnan(price), "NaN").when(price == float("inf"), "Infinity").alias("price_special"))


@query
def ingest_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 in S5: two runs, the second with files that the first has landed in part: every row lands once."""
    src_dir, out = scratch_path(spark, "messages"), scratch_path(spark, "landed")
    texts = catalog_messages(spark, sf_dir)
    third = F.pmod(F.xxhash64("value"), F.lit(3))
    for part in (third < 2, third > 0):
        texts.where(part).write.mode("append").text(src_dir)
        pipeline.ingest_stream(messages.read_message_files(spark, src_dir, streaming=True), out, distinct=True).awaitTermination()
    return pipeline.load_landed(spark, out)


@query
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 as a stream with two outputs: landed rows and quarantined records."""
    src_dir, out, bad = (scratch_path(spark, name) for name in ("messages", "landed", "quarantine"))
    _malformed_messages(spark, sf_dir).write.text(src_dir)
    pipeline.ingest_with_quarantine(messages.read_message_files(spark, src_dir, streaming=True), out, bad).awaitTermination()
    landed = pipeline.load_landed(spark, out).select(F.lit("landed").alias("output"), "appID", F.lit(None).cast("string").alias("record"))
    return landed.unionByName(pipeline.load_quarantined(spark, bad).select(
        F.lit("quarantined").alias("output"), F.lit(None).cast("string").alias("appID"), F.col("raw_record").alias("record")))


@query
def ingest_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the loop that stops after the batch with the close sentinel; the batch's other rows land."""
    src_dir, out = scratch_path(spark, "messages"), scratch_path(spark, "landed")
    _malformed_messages(spark, sf_dir).write.text(src_dir)
    closed = pipeline.ingest_until_close(messages.read_message_files(spark, src_dir, streaming=True), out, timeout_s=300)
    return _special_prices(pipeline.load_landed(spark, out)).withColumn("closed", F.lit(closed))


@query
def ingest_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3, M7, M8 on records with repeated keys, missing keys, nulls, and keys that differ by case alone."""
    key = F.col("p_partkey")
    bodies = ['"Positive":"3","Positive":"9"', '"Name":null,"name":"n"', '"name":"n"', '"Positive":null,"Positive":"4"',
              '"Positive":"4","Positive":null']
    body = F.get(F.array(*map(F.lit, bodies)), (key % len(bodies)).cast("int"))
    text = F.concat(F.lit('{"AppID":"'), key.cast("string"), F.lit('",'), body, F.lit("}"))
    rows = ingest.messages_to_rows(read_table(spark, sf_dir, "part").select(F.to_json(F.struct(text.alias("data"))).alias("value")))
    return rows.select("appID", "name", "positive")


# --------------------------------------------------- operators on driver tables
# The generic operators run unchanged on the large driver tables; these keep
# the skew-safe rank and quantile paths honest on high-cardinality doubles.

def _table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return read_table(spark, sf_dir, name).select(*cols)


@query
def welch_orders_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 on orders: total price by order priority."""
    o = _table(spark, sf_dir, "orders", "o_totalprice", "o_orderpriority")
    return _round_all(stats.welch_anova(o, "o_totalprice", "o_orderpriority", with_p=False))


@query
def tukey_orders_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 on orders: pairwise priority differences of total price."""
    o = _table(spark, sf_dir, "orders", "o_totalprice", "o_orderpriority")
    return _round_all(stats.tukey_hsd(o, "o_totalprice", "o_orderpriority", with_p=False))


@query
def tukey_orders_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 on orders: adjusted p-values, limits and decision for all pairs of priorities."""
    o = _table(spark, sf_dir, "orders", "o_totalprice", "o_orderpriority")
    t = stats.tukey_hsd(o, "o_totalprice", "o_orderpriority")
    return t.select("group1", "group2", r6("p_adj").alias("p_adj"), F.round("lower", 3).alias("lower"),
                    F.round("upper", 3).alias("upper"), "reject")


@query
def levene_lineitem_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on lineitem: extended price spread by return flag (exact medians)."""
    li = _table(spark, sf_dir, "lineitem", "l_extendedprice", "l_returnflag")
    return _round_all(stats.levene(li, "l_extendedprice", "l_returnflag", with_p=False))


@query
def mannwhitney_lineitem_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 on lineitem: extended price, return flag A vs R (global midranks)."""
    li = _table(spark, sf_dir, "lineitem", "l_extendedprice", "l_returnflag")
    return _round_all(stats.mann_whitney(li, "l_extendedprice", "l_returnflag", "A", "R",
                                         with_p=False))


@query
def ttest_lineitem_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 on lineitem: extended price with discount above vs at most 0.05."""
    li = _table(spark, sf_dir, "lineitem", "l_extendedprice", "l_discount")
    return _round_all(stats.welch_t_test(li, "l_extendedprice", F.col("l_discount") > 0.05,
                                         with_p=False))


@query
def welch_orders_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + T6 on orders: F, its p-value and the decision."""
    o = _table(spark, sf_dir, "orders", "o_totalprice", "o_orderpriority")
    res = stats.welch_anova(o, "o_totalprice", "o_orderpriority")
    return _round_all(stats.with_decision(res.withColumnRenamed("P_value", "p_value")).select(
        "F_statistic", "p_value", "reject", "decision"))


@query
def levene_lineitem_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T6 on lineitem: statistic, p-value and decision."""
    li = _table(spark, sf_dir, "lineitem", "l_extendedprice", "l_returnflag")
    return _round_all(stats.with_decision(stats.levene(li, "l_extendedprice", "l_returnflag")).select(
        "statistic", "p_value", "reject", "decision"))


@query
def ttest_lineitem_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + T6 on lineitem: t, p-value and decision."""
    li = _table(spark, sf_dir, "lineitem", "l_extendedprice", "l_discount")
    return _round_all(stats.welch_t_test(li, "l_extendedprice", F.col("l_discount") > 0.05).select(
        "t_statistic", "p_value", "reject", "decision"))


@query
def mannwhitney_lineitem_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 + T6 on lineitem: U, p-value and decision."""
    li = _table(spark, sf_dir, "lineitem", "l_extendedprice", "l_returnflag")
    res = stats.mann_whitney(li, "l_extendedprice", "l_returnflag", "A", "R")
    return _round_all(stats.with_decision(res.withColumnRenamed("P_value", "p_value")).select(
        "U_statistic", "p_value", "reject", "decision"))


@query
def mannwhitney_part_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 for each part: quantity of accepted against returned lines, exact given the ties."""
    li = _table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "l_returnflag")
    return _round_all(stats.mann_whitney_by(li, "l_quantity", "l_returnflag", "A", "R", ["l_partkey"]))


@query
def box_lineitem_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 on lineitem: extended price box statistics per return flag."""
    li = _table(spark, sf_dir, "lineitem", "l_extendedprice", "l_returnflag")
    return _round_all(charts.box_stats(li, "l_extendedprice", "l_returnflag"))


@query
def hist_lineitem_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 on lineitem: 50-bin extended price histogram per return flag."""
    li = _table(spark, sf_dir, "lineitem", "l_extendedprice", "l_returnflag")
    return _round_all(charts.histogram(li, "l_extendedprice", "l_returnflag", 50))


@query
def corr_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 on lineitem: pairwise correlations of the numeric measures."""
    li = _table(spark, sf_dir, "lineitem", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    c = correlation.corr_long(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return c.select("feature_a", "feature_b", r6("r").alias("r"))


# ------------------------------------------------------------- views and SQL

@query
def inspect_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred-schema read of the landed table, first 10 rows."""
    from ludica.sources.games import inspect, landed_path
    return inspect(spark, landed_path(spark, sf_dir), 10)


def register_analysis_views(spark: SparkSession, sf_dir: str, results: bool = False) -> list[str]:
    """The named views of the analyses.

    The three input views are lazy. With ``results`` the five result views
    are added too (correlation matrix, test results, regression and forest
    predictions); those fit the models, so they run jobs while registering.
    """
    views = {
        "popularity_table": popularity(spark, sf_dir),
        "anova_platform_table": platform_table(spark, sf_dir),
        "mann_whitney_genre_table": genre_table(spark, sf_dir).drop("appID"),
    }
    if results:
        model, data = _regression(spark, sf_dir)
        _, rf_pred = _forest(spark, sf_dir)
        views.update({
            "correlation_matrix_table": correlation.corr_wide(games(spark, sf_dir), NUMERIC),
            "anova_platform_results_table": anova_platform_results(spark, sf_dir),
            "mann_whitney_genre_results": mann_whitney_genre_results(spark, sf_dir),
            "predictions_table": model.transform(data),
            "rf_predictions_table": rf_pred,
        })
    register_views(views)
    return list(views)


@query
def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + S10: SQL over the registered views (ANOVA input, minus Mac Only)."""
    register_analysis_views(spark, sf_dir)
    return spark.sql("SELECT name, price, averagePlaytime, platform FROM anova_platform_table "
                     "WHERE platform <> 'Mac Only'")


@query
def sql_top_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-10 display query written in SQL over ``popularity_table``."""
    register_analysis_views(spark, sf_dir)
    return spark.sql("SELECT appID, name, round(ps, 6) AS popularityScore FROM ("
                     "SELECT appID, name, popularityScore AS ps FROM popularity_table "
                     "ORDER BY ps DESC NULLS LAST, appID LIMIT 10)")


@query
def platform_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct platform labels of the ANOVA input."""
    return agg.distinct_labels(platform_groups(spark, sf_dir), "platform")


@query
def playtime_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min and max of the playtime and review columns."""
    return agg.min_max(games(spark, sf_dir), "averagePlaytime", "medianPlaytime", "positive",
                       "negative")
