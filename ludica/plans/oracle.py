"""DuckDB oracle SQL for the registered queries.

Each text is the ``games`` view prefix (the same derivation as
``ludica.sources.games.games_from_tables``: the definition of the catalogue
fixture in SQL) plus one final SELECT. Computed numbers are cast to DOUBLE and rounded to 6
decimals on both sides; counts are BIGINT.
"""

from __future__ import annotations

GAMES_PREFIX = """
WITH li AS (
  SELECT l_partkey,
         CAST(SUM(l_quantity) AS INT) AS qty,
         CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS INT) AS pos,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INT) AS neg,
         CAST(SUM(l_linenumber) AS INT) AS lns,
         CAST(MAX(l_quantity) AS INT) AS mq
  FROM lineitem GROUP BY l_partkey),
base AS (
  SELECT CAST(p_partkey AS VARCHAR) AS appID,
         p_name AS name,
         concat('2024-01-', CAST(1 + p_partkey % 28 AS VARCHAR)) AS releaseDate,
         CASE WHEN p_partkey % 40 = 0 THEN 'unknown'
              ELSE concat(CAST(p_size * 100 AS VARCHAR), ' - ', CAST(p_size * 200 AS VARCHAR)) END AS estimatedOwners,
         CAST(floor(p_size * p_size * p_size / 50.0) AS INT) AS peakCCU,
         CAST((p_partkey % 5) * 3 AS INT) AS requiredAge,
         CAST(p_retailprice - 900 AS FLOAT) AS price,
         CAST(p_partkey % 4 AS INT) AS dlcCount,
         'English' AS languages, 'English' AS fullAudioLanguages, CAST(NULL AS VARCHAR) AS reviews,
         p_size % 10 <> 0 AS supportWindows, p_partkey % 3 = 0 AS supportMac, p_partkey % 4 = 0 AS supportLinux,
         CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE 50 + lns % 50 END AS metacriticScore,
         p_size * 2 AS userScore,
         CASE WHEN p_partkey % 30 = 0 THEN 0 ELSE pos END AS positive,
         CASE WHEN p_partkey % 30 = 0 THEN 0 ELSE neg END AS negative,
         CAST(NULL AS VARCHAR) AS scoreRank,
         lns % 37 AS achievements,
         CAST(3 * pos + floor(p_size * p_size / 10.0) AS INT) AS recommendations,
         greatest(0, qty - 600) AS averagePlaytime, mq % 7 AS averagePlaytime2W,
         greatest(0, qty - 650) AS medianPlaytime, mq % 5 AS medianPlaytime2W,
         CAST(NULL AS VARCHAR) AS packages, p_brand AS developers, p_brand AS publishers,
         'Single-player' AS categories,
         CASE p_type WHEN 'ECONOMY' THEN 'Action,Indie' WHEN 'LARGE' THEN 'Strategy'
                     WHEN 'MEDIUM' THEN 'Strategy,Action' WHEN 'PROMO' THEN 'ACTION'
                     WHEN 'SMALL' THEN 'Casual,strategy' ELSE NULL END AS genres,
         p_type AS tags
  FROM part JOIN li ON p_partkey = l_partkey),
raw AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE CAST(appID AS INT) % 10 = 0),
games AS (SELECT DISTINCT * FROM raw)
"""

# Reusable derived views (each defined on top of GAMES_PREFIX).
POPULARITY = """,
pop AS (
  SELECT *,
         CAST(positive AS DOUBLE) / nullif(CAST(positive AS DOUBLE) + CAST(negative AS DOUBLE), 0) AS sentimentRatio,
         CAST(averagePlaytime AS BIGINT) + CAST(averagePlaytime2W AS BIGINT) AS totalPlaytime,
         TRY_CAST(nullif(regexp_extract(estimatedOwners, '(\\d+)', 1), '') AS INT) AS estimatedOwnersNum
  FROM games),
pop2 AS (
  SELECT *,
         CASE WHEN sentimentRatio > 0.6 THEN 'Positive' WHEN sentimentRatio >= 0.4 THEN 'Neutral'
              ELSE 'Negative' END AS sentimentCategory,
         CAST(estimatedOwnersNum AS DOUBLE) * 0.4::DOUBLE + CAST(userScore AS DOUBLE) * 0.3::DOUBLE
           + CAST(totalPlaytime AS DOUBLE) * 0.3::DOUBLE AS popularityScore
  FROM pop)
"""

PLATFORM = """,
plat AS (
  SELECT *,
         CASE WHEN coalesce(supportWindows, false) AND coalesce(supportMac, false) AND coalesce(supportLinux, false) THEN 'All Platforms'
              WHEN coalesce(supportWindows, false) AND coalesce(supportMac, false) THEN 'Windows & Mac'
              WHEN coalesce(supportWindows, false) AND coalesce(supportLinux, false) THEN 'Windows & Linux'
              WHEN coalesce(supportWindows, false) THEN 'Windows Only'
              WHEN coalesce(supportMac, false) THEN 'Mac Only'
              WHEN coalesce(supportLinux, false) THEN 'Linux Only'
              ELSE 'Unknown' END AS platform
  FROM games),
anova AS (SELECT name, price, averagePlaytime, platform FROM plat WHERE price > 0 AND averagePlaytime > 0),
anova_nm AS (SELECT * FROM anova WHERE platform <> 'Mac Only')
"""

GENRE = """,
gt AS (
  SELECT *,
         CASE WHEN contains(lower(genres), 'action') THEN 'Action'
              WHEN contains(lower(genres), 'strategy') THEN 'Strategy' ELSE NULL END AS gameType
  FROM games),
mw AS (SELECT name, gameType, averagePlaytime FROM gt WHERE gameType IS NOT NULL AND averagePlaytime > 0)
"""


def q(*parts: str) -> str:
    return GAMES_PREFIX + "".join(parts)


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


register("popularity_top10", q(POPULARITY, """
SELECT appID, name, ROUND(ps, 6) AS popularityScore
FROM (SELECT appID, name, popularityScore AS ps FROM pop2
      ORDER BY ps DESC NULLS LAST, appID LIMIT 10) t
"""))

register("popularity_ranking", q(POPULARITY, """
SELECT appID, name, estimatedOwners, userScore, totalPlaytime,
       ROUND(popularityScore, 6) AS popularityScore, sentimentCategory
FROM pop2
"""))

register("sentiment_ratio", q(POPULARITY, """
SELECT appID, positive, negative, ROUND(sentimentRatio, 6) AS sentimentRatio, sentimentCategory FROM pop2
"""))

register("sentiment_difference", q("""
SELECT appID, positive, negative,
       CAST(positive AS BIGINT) - CAST(negative AS BIGINT) AS sentimentScore,
       CASE WHEN CAST(positive AS BIGINT) - CAST(negative AS BIGINT) > 0 THEN 'Positive'
            WHEN CAST(positive AS BIGINT) - CAST(negative AS BIGINT) = 0 THEN 'Neutral'
            ELSE 'Negative' END AS sentimentCategory
FROM games
"""))

register("owners_parse", q(POPULARITY, """
SELECT appID, estimatedOwners, estimatedOwnersNum FROM pop
"""))

register("dedupe_count", q("""
SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM games) AS distinct_rows
"""))

register("dedupe_rows", q("""
SELECT * FROM games
"""))

register("platform_filtered", q(PLATFORM, """
SELECT * FROM anova
"""))

register("platform_counts", q(PLATFORM, """
SELECT platform, count(*) AS count FROM anova_nm GROUP BY platform
"""))

register("genre_filtered", q(GENRE, """
SELECT * FROM mw
"""))

LABELED = """,
labeled AS (
  SELECT *, CASE WHEN peakCCU < 100 THEN 0 WHEN peakCCU >= 100 AND peakCCU < 1000 THEN 1 ELSE 2 END AS label
  FROM games WHERE peakCCU > 0)
"""

register("label_counts", q(LABELED, """
SELECT label, count(*) AS count FROM labeled GROUP BY label
"""))

register("split_80_20", q(LABELED, """
SELECT CASE WHEN substring(md5(concat('1234|', appID)), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split,
       label, count(*) AS count
FROM labeled GROUP BY 1, 2
"""))

register("trees_as_tables", q(LABELED, """
SELECT m.model, label, count(*) AS n, count(*) AS n_agree, any_value(m.votes) AS votes
FROM labeled, (VALUES ('tree', 1.0::DOUBLE), ('forest', 20.0::DOUBLE)) m(model, votes)
WHERE substring(md5(concat('1234|', appID)), 1, 8) >= 'cccccccc'
GROUP BY m.model, label
"""))

REGRESSION = """,
reg AS (
  SELECT appID, CAST(recommendations AS INT) AS recommendations, CAST(positive AS INT) AS positive,
         CAST(negative AS INT) AS negative, CAST(peakCCU AS INT) AS peakCCU
  FROM games
  WHERE substring(md5(concat('42|', appID)), 1, 8) < '19999999'
    AND recommendations IS NOT NULL AND positive IS NOT NULL AND negative IS NOT NULL AND peakCCU IS NOT NULL)
"""

register("sample_10", q(REGRESSION, """
SELECT * FROM reg
"""))

PLAYTIME = """,
pt AS (SELECT *, CAST(averagePlaytime AS DOUBLE) AS apt FROM games
       WHERE averagePlaytime IS NOT NULL AND CAST(averagePlaytime AS DOUBLE) > 0),
fence AS (
  SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
  FROM (SELECT quantile_disc(apt, 0.25) AS q1, quantile_disc(apt, 0.75) AS q3 FROM pt) t),
cleaned AS (SELECT pt.* FROM pt, fence WHERE apt BETWEEN lo AND hi)
"""

register("iqr_fence", q(PLAYTIME, """
SELECT ROUND(q1, 6) AS q1, ROUND(q3, 6) AS q3, ROUND(iqr, 6) AS iqr,
       ROUND(lo, 6) AS lower_bound, ROUND(hi, 6) AS upper_bound,
       (SELECT count(*) FROM pt) AS n_in, (SELECT count(*) FROM cleaned) AS n_kept
FROM fence
"""))

TRIM = """,
tb AS (SELECT quantile_cont(averagePlaytime, 0.05) AS lo, quantile_cont(averagePlaytime, 0.95) AS hi FROM anova_nm),
trimmed AS (SELECT a.* FROM anova_nm a, tb WHERE a.averagePlaytime >= tb.lo AND a.averagePlaytime <= tb.hi)
"""

register("percentile_trim", q(PLATFORM, TRIM, """
SELECT * FROM trimmed
"""))

register("levene_platform", q(PLATFORM, """,
med AS (SELECT platform, quantile_cont(averagePlaytime, 0.5) AS c FROM anova_nm GROUP BY platform),
z AS (SELECT a.platform, abs(CAST(a.averagePlaytime AS DOUBLE) - med.c) AS z FROM anova_nm a JOIN med USING (platform)),
zs AS (SELECT platform, CAST(count(*) AS DOUBLE) AS n, avg(z) AS zbar, var_samp(z) AS zvar FROM z GROUP BY platform),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS k, sum(n) AS ntot, sum(n * zbar) / sum(n) AS zall FROM zs),
ss AS (SELECT sum(zs.n * (zbar - zall) * (zbar - zall)) AS ssb, sum(coalesce((zs.n - 1) * zvar, 0)) AS ssw FROM zs, tot)
SELECT ROUND((ntot - k) / (k - 1) * ssb / ssw, 6) AS statistic, ROUND(k - 1, 6) AS df1, ROUND(ntot - k, 6) AS df2
FROM tot, ss
"""))

register("welch_platform", q(PLATFORM, """,
st AS (SELECT platform, CAST(count(*) AS DOUBLE) AS n, avg(CAST(averagePlaytime AS DOUBLE)) AS m,
              var_samp(CAST(averagePlaytime AS DOUBLE)) AS v FROM anova_nm GROUP BY platform),
wt AS (SELECT *, n / v AS w FROM st),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS k, sum(w) AS wsum, sum(w * m) / sum(w) AS mbar FROM wt),
parts AS (SELECT sum(w * (m - mbar) * (m - mbar)) / (k - 1) AS a,
                 sum((1 - w / wsum) * (1 - w / wsum) / (n - 1)) AS lam, k
          FROM wt, tot GROUP BY k)
SELECT ROUND(a / (1 + 2 * (k - 2) * lam / (k * k - 1)), 6) AS F_statistic,
       ROUND(k - 1, 6) AS df1, ROUND((k * k - 1) / (3 * lam), 6) AS df2
FROM parts
"""))

register("tukey_platform", q(PLATFORM, """,
st AS (SELECT platform, CAST(count(*) AS DOUBLE) AS n, avg(CAST(averagePlaytime AS DOUBLE)) AS m,
              var_samp(CAST(averagePlaytime AS DOUBLE)) AS v FROM anova_nm GROUP BY platform),
mse AS (SELECT sum((n - 1) * v) / (sum(n) - count(*)) AS mse FROM st)
SELECT a.platform AS group1, b.platform AS group2, ROUND(b.m - a.m, 6) AS meandiff,
       ROUND(abs(b.m - a.m) / sqrt(mse / 2 * (1 / a.n + 1 / b.n)), 6) AS q
FROM st a JOIN st b ON a.platform < b.platform, mse
"""))

MW_CORE = """,
vc AS (SELECT averagePlaytime AS v, CAST(count(*) AS DOUBLE) AS t,
              CAST(sum(CASE WHEN gameType = 'Action' THEN 1 ELSE 0 END) AS DOUBLE) AS na
       FROM mwin GROUP BY averagePlaytime),
rk AS (SELECT *, sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - (t - 1) / 2 AS midrank FROM vc),
s AS (SELECT sum(na * midrank) AS ra, sum(na) AS n1, sum(t) AS n, sum(t * t * t - t) AS tie_term FROM rk)
SELECT ROUND(ra - n1 * (n1 + 1) / 2, 6) AS U_statistic, CAST(n1 AS BIGINT) AS n_action,
       CAST(n - n1 AS BIGINT) AS n_strategy, ROUND(tie_term, 6) AS tie_term
FROM s
"""

register("mannwhitney_genre", q(GENRE, """,
mwin AS (SELECT * FROM mw WHERE gameType IN ('Action', 'Strategy'))
""", MW_CORE))

register("mannwhitney_downsampled", q(GENRE, """,
mwa AS (SELECT appID, gameType, averagePlaytime FROM gt WHERE gameType IS NOT NULL AND averagePlaytime > 0),
act AS (SELECT *, row_number() OVER (ORDER BY md5(concat('42|', appID)), appID) AS rn
        FROM mwa WHERE gameType = 'Action'),
mwin AS (SELECT gameType, averagePlaytime FROM act
         WHERE rn <= (SELECT count(*) FROM mwa WHERE gameType = 'Strategy')
         UNION ALL SELECT gameType, averagePlaytime FROM mwa WHERE gameType = 'Strategy')
""", MW_CORE))

register("ttest_metacritic", q(PLAYTIME, """,
s AS (SELECT count(CASE WHEN metacriticScore > 75 THEN apt END) AS n_high,
             count(CASE WHEN metacriticScore <= 75 THEN apt END) AS n_low,
             avg(CASE WHEN metacriticScore > 75 THEN apt END) AS mean_high,
             avg(CASE WHEN metacriticScore <= 75 THEN apt END) AS mean_low,
             var_samp(CASE WHEN metacriticScore > 75 THEN apt END) AS va,
             var_samp(CASE WHEN metacriticScore <= 75 THEN apt END) AS vb
      FROM cleaned)
SELECT n_high, n_low, ROUND(mean_high, 6) AS mean_high, ROUND(mean_low, 6) AS mean_low,
       ROUND(sqrt(va), 6) AS sd_high, ROUND(sqrt(vb), 6) AS sd_low,
       ROUND((mean_high - mean_low) / sqrt(va / n_high + vb / n_low), 6) AS t_statistic,
       ROUND((va / n_high + vb / n_low) * (va / n_high + vb / n_low)
             / ((va / n_high) * (va / n_high) / (n_high - 1) + (vb / n_low) * (vb / n_low) / (n_low - 1)), 6) AS df
FROM s
"""))

GENRE_TRIM = """,
gb AS (SELECT quantile_cont(averagePlaytime, 0.05) AS lo, quantile_cont(averagePlaytime, 0.95) AS hi FROM mw),
gtrim AS (SELECT m.* FROM mw m, gb WHERE m.averagePlaytime >= gb.lo AND m.averagePlaytime <= gb.hi)
"""


def _box(src: str, g: str, v: str = "averagePlaytime") -> str:
    return f""",
bq AS (SELECT {g}, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS median,
              quantile_cont({v}, 0.75) AS q3 FROM {src} GROUP BY {g}),
bj AS (SELECT t.{g}, CAST(t.{v} AS DOUBLE) AS v, q1, median, q3,
              q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
       FROM {src} t JOIN bq USING ({g}))
SELECT {g}, count(*) AS n, ROUND(avg(v), 6) AS mean, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median,
       ROUND(q3, 6) AS q3,
       ROUND(min(CASE WHEN v >= lo AND v <= hi THEN v END), 6) AS whisker_low,
       ROUND(max(CASE WHEN v >= lo AND v <= hi THEN v END), 6) AS whisker_high,
       count(CASE WHEN NOT (v >= lo AND v <= hi) THEN 1 END) AS n_outliers
FROM bj GROUP BY {g}, q1, median, q3
"""


def _hist(src: str, g: str, bins: int, v: str = "averagePlaytime") -> str:
    return f""",
he AS (SELECT min(CAST({v} AS DOUBLE)) AS lo, max(CAST({v} AS DOUBLE)) AS hi FROM {src}),
hb AS (SELECT {g}, CAST(least(floor((CAST({v} AS DOUBLE) - lo) * ({bins} / (hi - lo))), {bins - 1}) AS INT) AS bin,
              lo, (hi - lo) / {bins} AS step
       FROM {src}, he)
SELECT g.{g}, CAST(b.bin AS INT) AS bin, ROUND(he.lo + b.bin * ((he.hi - he.lo) / {bins}), 6) AS bin_lo,
       ROUND(he.lo + (b.bin + 1) * ((he.hi - he.lo) / {bins}), 6) AS bin_hi, count(hb.bin) AS count
FROM (SELECT DISTINCT {g} FROM {src}) g CROSS JOIN (SELECT range AS bin FROM range({bins})) b CROSS JOIN he
LEFT JOIN hb ON hb.{g} = g.{g} AND hb.bin = b.bin
GROUP BY 1, 2, 3, 4
"""


def _kde(src: str, g: str) -> str:
    return f""",
kp AS (SELECT {g}, CAST(count(*) AS DOUBLE) AS n, stddev_samp(CAST(averagePlaytime AS DOUBLE)) AS sd,
              min(CAST(averagePlaytime AS DOUBLE)) AS mn, max(CAST(averagePlaytime AS DOUBLE)) AS mx
       FROM {src} GROUP BY {g}),
kp2 AS (SELECT *, sd * pow(n, -0.2) AS bw FROM kp),
kp3 AS (SELECT *, mn AS g0, (mx - mn) / 199 AS step FROM kp2 WHERE bw > 0),
kv AS (SELECT {g}, CAST(averagePlaytime AS DOUBLE) AS v, CAST(count(*) AS DOUBLE) AS c FROM {src} GROUP BY 1, 2),
grid AS (SELECT CAST(range AS INTEGER) AS i FROM range(200))
SELECT {g}, i AS grid_index, ROUND(g0 + i * step, 6) AS x,
       ROUND(sum(c * exp(-0.5 * pow((g0 + i * step - v) / bw, 2))) / (n * bw * sqrt(2 * pi())), 9) AS density
FROM kv JOIN kp3 USING ({g}) CROSS JOIN grid
GROUP BY {g}, i, g0, step, n, bw
"""


register("box_platform", q(PLATFORM, TRIM, _box("trimmed", "platform")))
register("box_genre", q(GENRE, GENRE_TRIM, _box("gtrim", "gameType")))
register("hist_platform_30", q(PLATFORM, TRIM, _hist("trimmed", "platform", 30)))
register("hist_genre_50", q(GENRE, GENRE_TRIM, _hist("gtrim", "gameType", 50)))
register("kde_genre", q(GENRE, GENRE_TRIM, _kde("gtrim", "gameType")))
register("kde_platform", q(PLATFORM, TRIM, _kde("trimmed", "platform")))

# fixed values: the 14 numeric analysis columns in schema order
NUMERIC = ["peakCCU", "requiredAge", "price", "dlcCount", "metacriticScore", "userScore",
           "positive", "negative", "achievements", "recommendations", "averagePlaytime",
           "averagePlaytime2W", "medianPlaytime", "medianPlaytime2W"]
_PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]]


def _corr_long(digits: int) -> str:
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
             f"ROUND(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), {digits}) AS r FROM games"
             for a, b in _PAIRS]
    return q("\n" + "\nUNION ALL\n".join(parts))


register("corr_long", _corr_long(6))
register("corr_heatmap", _corr_long(2))

_LW = ",\nlw AS (SELECT * FROM games WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC) + ")\n"
register("corr_wide", q(_LW, "\nUNION ALL\n".join(
    "SELECT '" + a + "' AS feature, " + ", ".join(
        f"ROUND(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS {b}" for b in NUMERIC)
    + " FROM lw" for a in NUMERIC)))

REGRESSION_ALL = REGRESSION.replace("WHERE substring(md5(concat('42|', appID)), 1, 8) < '19999999'\n    AND", "WHERE")

register("poly_features", q(REGRESSION_ALL, """
SELECT appID, positive,
       CAST(recommendations AS DOUBLE) AS recommendations,
       CAST(recommendations AS DOUBLE) * recommendations AS recommendations_sq,
       CAST(negative AS DOUBLE) AS negative,
       CAST(recommendations AS DOUBLE) * negative AS recommendations_x_negative,
       CAST(negative AS DOUBLE) * negative AS negative_sq,
       CAST(peakCCU AS DOUBLE) AS peakCCU,
       CAST(recommendations AS DOUBLE) * peakCCU AS recommendations_x_peakCCU,
       CAST(negative AS DOUBLE) * peakCCU AS negative_x_peakCCU,
       CAST(peakCCU AS DOUBLE) * peakCCU AS peakCCU_sq
FROM reg
"""))

register("ingest_map", q("""
SELECT appID, name, releaseDate, estimatedOwners,
       CASE WHEN CAST(appID AS BIGINT) % 7 = 0 THEN 0 ELSE peakCCU END AS peakCCU,
       requiredAge, price, dlcCount,
       CAST(NULL AS VARCHAR) AS longDesc, CAST(NULL AS VARCHAR) AS shortDesc,
       languages, fullAudioLanguages, reviews,
       CAST(NULL AS VARCHAR) AS headerImage, CAST(NULL AS VARCHAR) AS website,
       CAST(NULL AS VARCHAR) AS supportWeb, CAST(NULL AS VARCHAR) AS supportEmail,
       supportWindows, supportMac,
       CASE WHEN CAST(appID AS BIGINT) % 13 = 0 THEN false ELSE supportLinux END AS supportLinux,
       metacriticScore, CAST(NULL AS VARCHAR) AS metacriticURL, userScore, positive, negative, scoreRank,
       CASE WHEN CAST(appID AS BIGINT) % 17 = 0 THEN 0 ELSE achievements END AS achievements,
       recommendations, CAST(NULL AS VARCHAR) AS notes,
       averagePlaytime, averagePlaytime2W, medianPlaytime, medianPlaytime2W,
       CAST(NULL AS VARCHAR) AS packages, developers, publishers, categories, genres,
       CAST(NULL AS VARCHAR) AS screenshots, CAST(NULL AS VARCHAR) AS movies, tags
FROM raw
WHERE peakCCU IS NOT NULL AND requiredAge IS NOT NULL AND price IS NOT NULL AND dlcCount IS NOT NULL
  AND supportWindows IS NOT NULL AND supportMac IS NOT NULL AND supportLinux IS NOT NULL
  AND metacriticScore IS NOT NULL AND userScore IS NOT NULL AND positive IS NOT NULL
  AND negative IS NOT NULL AND achievements IS NOT NULL AND recommendations IS NOT NULL
  AND averagePlaytime IS NOT NULL AND averagePlaytime2W IS NOT NULL AND medianPlaytime IS NOT NULL
  AND medianPlaytime2W IS NOT NULL
"""))

# The streamed landing must equal the batch mapping row for row.
register("ingest_stream", ORACLE["ingest_map"])


# ----------------------------------------------------- driver tables directly

def _welch(src: str, v: str, g: str) -> str:
    return f"""
WITH st AS (SELECT {g} AS g, CAST(count(*) AS DOUBLE) AS n, avg(CAST({v} AS DOUBLE)) AS m,
                   var_samp(CAST({v} AS DOUBLE)) AS v FROM {src} WHERE {g} IS NOT NULL AND {v} IS NOT NULL GROUP BY {g}),
wt AS (SELECT *, n / v AS w FROM st),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS k, sum(w) AS wsum, sum(w * m) / sum(w) AS mbar FROM wt),
parts AS (SELECT sum(w * (m - mbar) * (m - mbar)) / (k - 1) AS a,
                 sum((1 - w / wsum) * (1 - w / wsum) / (n - 1)) AS lam, k
          FROM wt, tot GROUP BY k)
SELECT ROUND(a / (1 + 2 * (k - 2) * lam / (k * k - 1)), 6) AS F_statistic,
       ROUND(k - 1, 6) AS df1, ROUND((k * k - 1) / (3 * lam), 6) AS df2
FROM parts
"""


register("welch_orders_priority", _welch("orders", "o_totalprice", "o_orderpriority"))

register("tukey_orders_priority", """
WITH st AS (SELECT o_orderpriority AS g, CAST(count(*) AS DOUBLE) AS n, avg(o_totalprice) AS m,
                   var_samp(o_totalprice) AS v FROM orders GROUP BY o_orderpriority),
mse AS (SELECT sum((n - 1) * v) / (sum(n) - count(*)) AS mse FROM st)
SELECT a.g AS group1, b.g AS group2, ROUND(b.m - a.m, 6) AS meandiff,
       ROUND(abs(b.m - a.m) / sqrt(mse / 2 * (1 / a.n + 1 / b.n)), 6) AS q
FROM st a JOIN st b ON a.g < b.g, mse
""")

register("levene_lineitem_flag", """
WITH med AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS c FROM lineitem GROUP BY 1),
z AS (SELECT l.l_returnflag, abs(l.l_extendedprice - med.c) AS z FROM lineitem l JOIN med USING (l_returnflag)),
zs AS (SELECT l_returnflag, CAST(count(*) AS DOUBLE) AS n, avg(z) AS zbar, var_samp(z) AS zvar FROM z GROUP BY 1),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS k, sum(n) AS ntot, sum(n * zbar) / sum(n) AS zall FROM zs),
ss AS (SELECT sum(zs.n * (zbar - zall) * (zbar - zall)) AS ssb, sum(coalesce((zs.n - 1) * zvar, 0)) AS ssw FROM zs, tot)
SELECT ROUND((ntot - k) / (k - 1) * ssb / ssw, 6) AS statistic, ROUND(k - 1, 6) AS df1, ROUND(ntot - k, 6) AS df2
FROM tot, ss
""")

register("mannwhitney_lineitem_flag", """
WITH vc AS (SELECT l_extendedprice AS v, CAST(count(*) AS DOUBLE) AS t,
                   CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS DOUBLE) AS na
            FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1),
rk AS (SELECT *, sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - (t - 1) / 2 AS midrank FROM vc),
s AS (SELECT sum(na * midrank) AS ra, sum(na) AS n1, sum(t) AS n, sum(t * t * t - t) AS tie_term FROM rk)
SELECT ROUND(ra - n1 * (n1 + 1) / 2, 6) AS U_statistic, CAST(n1 AS BIGINT) AS n_first,
       CAST(n - n1 AS BIGINT) AS n_second, ROUND(tie_term, 6) AS tie_term
FROM s
""")

register("ttest_lineitem_discount", """
WITH s AS (SELECT count(CASE WHEN l_discount > 0.05 THEN l_extendedprice END) AS n_high,
                  count(CASE WHEN l_discount <= 0.05 THEN l_extendedprice END) AS n_low,
                  avg(CASE WHEN l_discount > 0.05 THEN l_extendedprice END) AS mean_high,
                  avg(CASE WHEN l_discount <= 0.05 THEN l_extendedprice END) AS mean_low,
                  var_samp(CASE WHEN l_discount > 0.05 THEN l_extendedprice END) AS va,
                  var_samp(CASE WHEN l_discount <= 0.05 THEN l_extendedprice END) AS vb
           FROM lineitem)
SELECT n_high, n_low, ROUND(mean_high, 6) AS mean_high, ROUND(mean_low, 6) AS mean_low,
       ROUND(sqrt(va), 6) AS sd_high, ROUND(sqrt(vb), 6) AS sd_low,
       ROUND((mean_high - mean_low) / sqrt(va / n_high + vb / n_low), 6) AS t_statistic,
       ROUND((va / n_high + vb / n_low) * (va / n_high + vb / n_low)
             / ((va / n_high) * (va / n_high) / (n_high - 1) + (vb / n_low) * (vb / n_low) / (n_low - 1)), 6) AS df
FROM s
""")

register("box_lineitem_flag", "WITH src AS (SELECT * FROM lineitem)"
         + _box("src", "l_returnflag", "l_extendedprice"))
register("hist_lineitem_price", "WITH src AS (SELECT * FROM lineitem)"
         + _hist("src", "l_returnflag", 50, "l_extendedprice"))

_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
register("corr_lineitem", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, ROUND(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(_LI) for b in _LI[i + 1:]))

register("regression_collinear", """
WITH s AS (
  SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice) AS my,
         var_pop(l_quantity) AS xx, var_pop(l_discount) AS zz, covar_pop(l_quantity, l_discount) AS xz,
         covar_pop(l_quantity, l_extendedprice) AS xy, covar_pop(l_discount, l_extendedprice) AS zy
  FROM lineitem WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_extendedprice IS NOT NULL),
b AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM s)
SELECT 'intercept' AS term, round(my - bx * mx - bz * mz, 3) AS coefficient, n, 2::INTEGER AS rank FROM b
UNION ALL SELECT 'l_quantity', round(bx, 3), n, 2::INTEGER FROM b
UNION ALL SELECT 'twice', NULL::DOUBLE, n, 2::INTEGER FROM b
UNION ALL SELECT 'l_discount', round(bz, 3), n, 2::INTEGER FROM b
""")

register("sketch_quantiles_by_date", """
SELECT l_returnflag, count(l_extendedprice) AS n, true AS q05_within, true AS q25_within, true AS q50_within,
       true AS q75_within, true AS q95_within
FROM lineitem GROUP BY l_returnflag
""")

register("hist_special_values", """
WITH f AS (SELECT p_brand, CAST(p_retailprice AS DOUBLE) AS v FROM part WHERE p_partkey % 50 > 2),
e AS (SELECT min(v) AS lo, max(v) AS hi FROM f),
c AS (SELECT p_brand, CAST(least(floor((v - lo) * (10 / (hi - lo))), 9) AS INT) AS bin, count(*) AS n FROM f, e GROUP BY 1, 2),
g AS (SELECT p_brand, CAST(b AS INT) AS bin FROM (SELECT DISTINCT p_brand FROM part), range(10) r(b))
SELECT g.p_brand, g.bin, coalesce(c.n, 0) AS count FROM g LEFT JOIN c ON c.p_brand = g.p_brand AND c.bin = g.bin
UNION ALL
SELECT p_brand, NULL, count(*) FROM part WHERE p_partkey % 50 <= 2 GROUP BY p_brand
""")

register("corr_no_rows", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature, " + ", ".join(f"corr({a}, {b}) AS {b}" for b in ("l_quantity", "l_discount", "l_tax"))
    + " FROM lineitem WHERE l_quantity < 0" for a in ("l_quantity", "l_discount", "l_tax")))

register("sql_over_views", q(PLATFORM, """
SELECT name, price, averagePlaytime, platform FROM anova WHERE platform <> 'Mac Only'
"""))

register("sql_top_popularity", ORACLE["popularity_top10"])

register("inspect_landed", q("""
SELECT * FROM raw ORDER BY appID LIMIT 10
"""))

register("platform_labels", q(PLATFORM, """
SELECT DISTINCT platform FROM anova_nm
"""))

register("playtime_range", q("""
SELECT min(averagePlaytime) AS min_averagePlaytime, max(averagePlaytime) AS max_averagePlaytime,
       min(medianPlaytime) AS min_medianPlaytime, max(medianPlaytime) AS max_medianPlaytime,
       min(positive) AS min_positive, max(positive) AS max_positive,
       min(negative) AS min_negative, max(negative) AS max_negative
FROM games
"""))


def _sse_messages() -> str:
    """Envelope texts of the event-stream records built from the landed rows:
    the record under its source keys (json_object keeps key order and writes
    SQL NULL as JSON null), with the same alternative spellings."""
    from ludica.operators.ingest import RENAMES
    from ludica.schema import ANALYSIS_COLUMNS
    key = "CAST(appID AS BIGINT)"
    spell = {
        "peakCCU": f"CASE WHEN {key} % 7 = 0 THEN concat(CAST(peakCCU AS VARCHAR), '.0') "
                   "ELSE CAST(peakCCU AS VARCHAR) END",
        "supportMac": f"CASE WHEN supportMac IS NULL THEN NULL WHEN {key} % 11 = 0 "
                      "THEN upper(CAST(supportMac AS VARCHAR)) ELSE CAST(supportMac AS VARCHAR) END",
        "supportLinux": f"CASE WHEN supportLinux IS NULL THEN NULL WHEN {key} % 13 = 0 THEN 'yes' "
                        "ELSE CAST(supportLinux AS VARCHAR) END",
        "achievements": f"CASE WHEN achievements IS NULL THEN NULL WHEN {key} % 17 = 0 "
                        "THEN concat(' ', CAST(achievements AS VARCHAR)) "
                        "ELSE CAST(achievements AS VARCHAR) END",
    }
    pairs = [f"'{src}', {spell.get(dst, f'CAST({dst} AS VARCHAR)')}"
             for src, dst in RENAMES if dst in ANALYSIS_COLUMNS]
    inner = "json_object(" + ", ".join(pairs) + ")"
    return q(f"\nSELECT CAST(json_object('data', CAST({inner} AS VARCHAR)) AS VARCHAR) AS value FROM raw\n")


register("sse_messages", _sse_messages())


_TERMS = {
    "intercept": "1", "recommendations": "recommendations", "recommendations_sq": "recommendations * recommendations",
    "negative": "negative", "recommendations_x_negative": "recommendations * negative", "negative_sq": "negative * negative",
    "peakCCU": "peakCCU", "recommendations_x_peakCCU": "recommendations * peakCCU",
    "negative_x_peakCCU": "negative * peakCCU", "peakCCU_sq": "peakCCU * peakCCU"}
register("regression_normal_equations", q(REGRESSION_ALL, """,
d AS (SELECT CAST(recommendations AS DOUBLE) AS recommendations, CAST(negative AS DOUBLE) AS negative,
             CAST(peakCCU AS DOUBLE) AS peakCCU, CAST(positive AS DOUBLE) AS positive FROM reg)
""", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS term, count(*) AS n, sum(({sql}) * positive) AS sum_xy, CAST(1.0 AS DOUBLE) AS ratio FROM d"
    for name, sql in _TERMS.items())))

RULE = LABELED + """,
rule AS (SELECT label, CASE WHEN coalesce(positive, 0) > coalesce(negative, 0) THEN 2 ELSE 0 END AS said FROM labeled)
"""
register("accuracy_rule", q(RULE, """
SELECT ROUND(avg(CASE WHEN label = said THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM rule
"""))
register("confusion_rule", q(RULE, "\nUNION ALL\n".join(
    f"SELECT CAST({k} AS INT) AS label, '{name}' AS label_name, "
    + ", ".join(f"count(CASE WHEN label = {k} AND said = {i} THEN 1 END) AS predicted_{other}"
                for i, other in enumerate(("Low", "Medium", "High"))) + " FROM rule"
    for k, name in enumerate(("Low", "Medium", "High")))))

register("split_null_keys", q(""",
keyed AS (SELECT CASE WHEN CAST(appID AS BIGINT) % 6 <> 0 THEN appID END AS k FROM games)
SELECT s.split, count(keyed.side) AS rows, count(CASE WHEN keyed.side IS NOT NULL AND k IS NULL THEN 1 END) AS null_keys
FROM (VALUES ('train'), ('test')) s(split)
LEFT JOIN (SELECT k, CASE WHEN substring(md5(concat('1234|', coalesce(k, ''))), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS side
           FROM keyed) keyed ON keyed.side = s.split
GROUP BY s.split
"""))

register("ingest_twice", ORACLE["ingest_map"])
register("ingest_malformed", """
SELECT CASE WHEN p_partkey % 14 > 0 THEN CAST(p_partkey AS VARCHAR) END AS appID,
       CAST(CASE p_partkey % 14 WHEN 6 THEN 0 WHEN 12 THEN 7 WHEN 13 THEN 0 END AS INT) AS positive,
       CAST(CASE WHEN p_partkey % 14 IN (7, 8) THEN 0.0 WHEN p_partkey % 14 = 11 THEN 1.5 END AS DOUBLE) AS price,
       CASE p_partkey % 14 WHEN 9 THEN 'Infinity' WHEN 10 THEN 'NaN' END AS price_special
FROM part WHERE p_partkey % 14 NOT IN (1, 2, 3, 4, 5)
""")


register("ingest_distinct", "SELECT DISTINCT * FROM (" + ORACLE["ingest_map"] + ")")
register("ingest_quarantine", """
SELECT 'landed' AS output, CAST(p_partkey AS VARCHAR) AS appID, CAST(NULL AS VARCHAR) AS record
FROM part WHERE p_partkey % 14 > 5
UNION ALL SELECT 'quarantined', NULL, 'no json' FROM part WHERE p_partkey % 14 = 0
""")
register("ingest_closed", "SELECT *, 1 AS closed FROM (" + ORACLE["ingest_malformed"] + ")")
register("ingest_keys", """
SELECT CAST(p_partkey AS VARCHAR) AS appID, CASE WHEN p_partkey % 5 = 2 THEN 'n' END AS name,
       CAST(CASE p_partkey % 5 WHEN 0 THEN 9 WHEN 3 THEN 4 END AS INT) AS positive
FROM part WHERE p_partkey % 5 <> 4
""")


# p-values: the densities integrated by Simpson's rule from 0 to the statistic.

def _p_value(stat: str, upper: str, density: str, sides: int, out: str) -> str:
    """1 - sides * (integral of ``density`` over u from 0 to ``upper``) as p of the one row of ``stat``."""
    exact = stat.replace("ROUND(", "(").replace(", 6)", ")")
    n = 20_000
    return f"""
WITH st AS ({exact}),
grid AS (SELECT st.*, ({upper}) * i / {n} AS u,
                CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w, ({upper}) / {n} AS h
         FROM st CROSS JOIN (SELECT range AS i FROM range({n} + 1)) r),
p AS (SELECT greatest(0.0, 1 - {sides} * sum(w * ({density})) * any_value(h) / 3) AS p FROM grid)
SELECT {out}, ROUND(p, 6) AS p_value, p < 0.05 AS reject,
       CASE WHEN p < 0.05 THEN 'difference' ELSE 'no difference shown' END AS decision
FROM st, p
"""


def _f_density(d1: str, d2: str) -> str:
    return (f"exp(lgamma(({d1} + {d2}) / 2) - lgamma({d1} / 2) - lgamma({d2} / 2) + {d1} / 2 * ln({d1} / {d2})"
            f" - ({d1} + {d2}) / 2 * ln(1 + {d1} * u / {d2})) * pow(u, {d1} / 2 - 1)")


register("welch_orders_test", _p_value(ORACLE["welch_orders_priority"], "F_statistic", _f_density("df1", "df2"), 1,
                                       "ROUND(F_statistic, 6) AS F_statistic"))
register("levene_lineitem_test", _p_value(ORACLE["levene_lineitem_flag"], "statistic", _f_density("df1", "df2"), 1,
                                          "ROUND(statistic, 6) AS statistic"))
register("ttest_lineitem_test", _p_value(
    ORACLE["ttest_lineitem_discount"], "abs(t_statistic)",
    "exp(lgamma((df + 1) / 2) - lgamma(df / 2) - (df + 1) / 2 * ln(1 + u * u / df)) / sqrt(df * pi())", 2,
    "ROUND(t_statistic, 6) AS t_statistic"))
register("mannwhitney_lineitem_test", _p_value(
    ORACLE["mannwhitney_lineitem_flag"],
    "greatest(0, greatest(U_statistic, CAST(n_first AS DOUBLE) * n_second - U_statistic) - CAST(n_first AS DOUBLE) * n_second / 2 - 0.5)"
    " / sqrt(CAST(n_first AS DOUBLE) * n_second / 12 * (n_first + n_second + 1"
    " - tie_term / (CAST(n_first + n_second AS DOUBLE) * (n_first + n_second - 1))))",
    "exp(-u * u / 2) / sqrt(2 * pi())", 2, "ROUND(U_statistic, 6) AS U_statistic"))

# Mann-Whitney given the ties: ways to draw the first sample by twice its midrank sum, a tie group a step.
register("mannwhitney_part_exact", """
WITH RECURSIVE vc AS (SELECT l_partkey, l_quantity AS v, count(*) AS t, count(*) FILTER (l_returnflag = 'A') AS na
                      FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2),
rk AS (SELECT l_partkey, t, na, row_number() OVER w AS i, CAST(2 * sum(t) OVER w - t + 1 AS BIGINT) AS doubled
       FROM vc WINDOW w AS (PARTITION BY l_partkey ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT l_partkey, CAST(sum(na * doubled) AS BIGINT) AS d, CAST(sum(na) AS BIGINT) AS n1, CAST(sum(t) AS BIGINT) AS n,
             max(i) AS last, CAST(sum(t * t * t - t) AS DOUBLE) AS tie_term FROM rk GROUP BY 1),
walk(l_partkey, i, j, d, ways) AS (
  SELECT l_partkey, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS DOUBLE) FROM s WHERE n1 BETWEEN 1 AND n - 1
  UNION ALL
  SELECT l_partkey, i, j, d, sum(ways) FROM (
    SELECT w.l_partkey, rk.i, w.j + c.c AS j, w.d + c.c * rk.doubled AS d,
           w.ways * round(exp(lgamma(rk.t + 1) - lgamma(c.c + 1) - lgamma(rk.t - c.c + 1))) AS ways
    FROM walk w JOIN rk ON rk.l_partkey = w.l_partkey AND rk.i = w.i + 1 JOIN s ON s.l_partkey = w.l_partkey
    JOIN (SELECT range AS c FROM range(101)) c ON c.c <= rk.t AND c.c <= s.n1 - w.j) step
  GROUP BY ALL),
tails AS (SELECT s.l_partkey, sum(w.ways) AS ways, sum(w.ways) FILTER (w.d >= s.d) AS high, sum(w.ways) FILTER (w.d <= s.d) AS low
          FROM walk w JOIN s ON s.l_partkey = w.l_partkey AND w.i = s.last AND w.j = s.n1 GROUP BY 1)
SELECT s.l_partkey, CASE WHEN n1 BETWEEN 1 AND n - 1 THEN ROUND(d / 2.0 - n1 * (n1 + 1) / 2.0, 6) END AS U_statistic,
       n1 AS n_first, n - n1 AS n_second, ROUND(tie_term, 6) AS tie_term,
       ROUND(least(1.0, 2 * least(high, low) / ways), 6) AS P_value,
       CASE WHEN n1 BETWEEN 1 AND n - 1 THEN 'exact' END AS method
FROM s LEFT JOIN tails USING (l_partkey)
""")

# Tukey's tail: sums over even grids of the maximum z and the scaled deviation s, where the integrand vanishes at both
# ends; the normal distribution by its series; the critical value by bisection.
_PHI = ("(CASE WHEN {x} < -8.5 THEN 0.0 WHEN {x} > 8.5 THEN 1.0 ELSE 0.5 + sign({x}) * exp(-({x}) * ({x}) / 2) / sqrt(2 * pi())"
        " * list_sum(list_transform(odd, lambda o, n: exp((2 * n - 1) * ln(greatest(abs({x}), 1e-30)) - o))) END)")
_RANGE_CDF = ("sum(ws * k * wz * pow(greatest(pz - " + _PHI.format(x="(z - q * s)") + ", 0), k - 1))")
register("tukey_orders_test", f"""
WITH RECURSIVE st AS (SELECT o_orderpriority AS g, CAST(count(*) AS DOUBLE) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v
                      FROM orders GROUP BY 1),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS k, sum(n) - count(*) AS df, sum((n - 1) * v) / (sum(n) - count(*)) AS mse FROM st),
pairs AS (SELECT a.g AS group1, b.g AS group2, b.m - a.m AS meandiff, sqrt(mse / 2 * (1 / a.n + 1 / b.n)) AS se,
                 abs(b.m - a.m) / sqrt(mse / 2 * (1 / a.n + 1 / b.n)) AS q
          FROM st a JOIN st b ON a.g < b.g, tot),
coef AS (SELECT list(lgamma(range + 1.5) + (range + 1) * ln(2.0) - 0.5 * ln(pi()) ORDER BY range) AS odd FROM range(140)),
zs AS (SELECT odd, -8.5 + 0.1 * range AS z, 0.1 * exp(-pow(-8.5 + 0.1 * range, 2) / 2) / sqrt(2 * pi()) AS wz FROM range(171), coef),
zp AS (SELECT z, wz, odd, {_PHI.format(x='z')} AS pz FROM zs),
sg AS (SELECT k, 1 + (range - 30) * 0.3 / sqrt(2 * df) AS s,
              exp((df - 1) * ln(1 + (range - 30) * 0.3 / sqrt(2 * df)) - df * (pow(1 + (range - 30) * 0.3 / sqrt(2 * df), 2) - 1) / 2) AS f
       FROM range(61), tot WHERE 1 + (range - 30) * 0.3 / sqrt(2 * df) > 0),
sw AS (SELECT k, s, f / sum(f) OVER () AS ws FROM sg),
grid AS (SELECT * FROM zp, sw),
tail AS (SELECT group1, group2, 1 - {_RANGE_CDF} AS p FROM pairs, grid GROUP BY 1, 2),
bis(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(64 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN c < 0.95 THEN q ELSE lo END, CASE WHEN c < 0.95 THEN hi ELSE q END
  FROM (SELECT i, lo, hi, q, {_RANGE_CDF} AS c FROM (SELECT *, (lo + hi) / 2 AS q FROM bis WHERE i < 44) b, grid GROUP BY 1, 2, 3, 4) t)
SELECT group1, group2, ROUND(p, 6) AS p_adj, ROUND(meandiff - (lo + hi) / 2 * se, 3) AS lower,
       ROUND(meandiff + (lo + hi) / 2 * se, 3) AS upper, p < 0.05 AS reject
FROM pairs JOIN tail USING (group1, group2), bis WHERE i = 44
""")
