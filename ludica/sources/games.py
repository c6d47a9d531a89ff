"""Game-catalogue tables: the landed Parquet reader and the driver-table view.

``games_from_tables`` derives a catalogue with the analysis schema from the
driver's ``part`` and ``lineitem`` tables, so every analysis runs on data
that grows with the scale factor. The derivation is the one fixed in
FIXTURES.md (X6) and is mirrored in SQL by ``ludica.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludica.schema import ANALYSIS_COLUMNS, ANALYSIS_SCHEMA
from ludica.sources.tables import read_table


def load_games(spark: SparkSession, path: str) -> DataFrame:
    """Landed Parquet read with the declared analysis schema.

    The declared schema means no footer inference and only the 31 analysis
    columns are read (the scan's ReadSchema prunes the text columns).
    """
    return spark.read.schema(ANALYSIS_SCHEMA).parquet(path)


def inspect(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """Inferred-schema read; prints the schema and returns the first n rows."""
    df = spark.read.parquet(path)
    df.printSchema()
    return df.orderBy(df.columns[0]).limit(n)      # the first rows by key, the same ones every time


def register_views(results: dict[str, DataFrame]) -> None:
    """Expose named results as temp views (e.g. ``popularity_table``)."""
    for name, df in results.items():
        df.createOrReplaceTempView(name)


def _lineitem_by_part(lineitem: DataFrame) -> DataFrame:
    # Partial (map-side) aggregation runs before the shuffle on l_partkey,
    # so a hot part key costs one row per map task, not one per line.
    return lineitem.groupBy("l_partkey").agg(
        F.sum("l_quantity").cast("long").alias("qty"),
        F.sum(F.when(F.col("l_returnflag") == "N", 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("neg"),
        F.sum("l_linenumber").alias("lns"),
        F.max("l_quantity").cast("long").alias("mq"),
    )


def _genres(p_type: Column) -> Column:
    # fixed values: part type -> genre text of the fixture catalogue
    return (F.when(p_type == "ECONOMY", "Action,Indie")
            .when(p_type == "LARGE", "Strategy")
            .when(p_type == "MEDIUM", "Strategy,Action")
            .when(p_type == "PROMO", "ACTION")
            .when(p_type == "SMALL", "Casual,strategy")
            .otherwise(F.lit(None).cast("string")))


def _saturated(c: Column, dtype) -> Column:
    """Cast to a column's type; sums over very many lines stop at the largest int."""
    if dtype.typeName() == "integer":
        c = F.when(c > 2 ** 31 - 1, 2 ** 31 - 1).otherwise(c)
    return c.cast(dtype)


def games_from_tables(part: DataFrame, lineitem: DataFrame,
                      with_duplicates: bool = True) -> DataFrame:
    """Catalogue rows (analysis schema) built from ``part`` and ``lineitem``.

    With ``with_duplicates`` every tenth part key appears twice, which is
    what a re-delivering ingest leaves behind; ``dedupe`` removes them.
    The copies come from one ``explode`` instead of a second scan + union.
    """
    li = _lineitem_by_part(lineitem.select(
        "l_partkey", "l_quantity", "l_returnflag", "l_linenumber"))
    p = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    j = p.join(li, p["p_partkey"] == li["l_partkey"], "inner")

    pk, size = F.col("p_partkey"), F.col("p_size")
    null_str = F.lit(None).cast("string")
    cols = {
        "appID": pk.cast("string"),
        "name": F.col("p_name"),
        "releaseDate": F.concat(F.lit("2024-01-"), (1 + pk % 28).cast("string")),
        "estimatedOwners": F.when(pk % 40 == 0, F.lit("unknown")).otherwise(
            F.concat((size * 100).cast("string"), F.lit(" - "), (size * 200).cast("string"))),
        "peakCCU": F.floor(size * size * size / F.lit(50.0)),
        "requiredAge": (pk % 5) * 3,
        "price": (F.col("p_retailprice") - 900).cast("float"),
        "dlcCount": pk % 4,
        "languages": F.lit("English"),
        "fullAudioLanguages": F.lit("English"),
        "reviews": null_str,
        "supportWindows": size % 10 != 0,
        "supportMac": pk % 3 == 0,
        "supportLinux": pk % 4 == 0,
        "metacriticScore": F.when(pk % 20 == 0, F.lit(None).cast("int"))
                            .otherwise(50 + F.col("lns") % 50),
        "userScore": size * 2,
        "positive": F.when(pk % 30 == 0, F.lit(0)).otherwise(F.col("pos")),
        "negative": F.when(pk % 30 == 0, F.lit(0)).otherwise(F.col("neg")),
        "scoreRank": null_str,
        "achievements": F.col("lns") % 37,
        "recommendations": 3 * F.col("pos") + F.floor(size * size / F.lit(10.0)),
        "averagePlaytime": F.greatest(F.lit(0), F.col("qty") - 600),
        "averagePlaytime2W": F.col("mq") % 7,
        "medianPlaytime": F.greatest(F.lit(0), F.col("qty") - 650),
        "medianPlaytime2W": F.col("mq") % 5,
        "packages": null_str,
        "developers": F.col("p_brand"),
        "publishers": F.col("p_brand"),
        "categories": F.lit("Single-player"),
        "genres": _genres(F.col("p_type")),
        "tags": F.col("p_type"),
    }
    if with_duplicates:
        copies = F.when(pk % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        j = j.withColumn("_copy", F.explode(copies))
    return j.select(*[_saturated(cols[c], ANALYSIS_SCHEMA[c].dataType).alias(c) for c in ANALYSIS_COLUMNS])


ROWS_PER_FILE = 1_000_000
_LANDED: dict[tuple[str, str], str] = {}


def landed_path(spark: SparkSession, sf_dir: str) -> str:
    """The catalogue derived from ``sf_dir`` written once per session as
    Parquet under the shared checkpoint folder - the stand-in for the table
    ingest lands. Later reads prune columns and push filters into its scan.
    """
    from ludica.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir)
    path = _LANDED.get(key)
    if path is None:
        path = scratch_path(spark, "landed-games")
        # files of at most ROWS_PER_FILE rows, and at least one per core for the
        # CPU-heavy parsing of the ingest queries
        part = read_table(spark, sf_dir, "part")
        files = max(spark.sparkContext.defaultParallelism, -(-part.count() // ROWS_PER_FILE))
        (games_from_tables(part, read_table(spark, sf_dir, "lineitem"))
         .repartition(files).write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path))
        _LANDED[key] = path
    return path


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed catalogue rows, re-delivery duplicates included (S6 read)."""
    return load_games(spark, landed_path(spark, sf_dir))


def deduped_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 applied to the landed rows (one shuffle, copies collapsed map-side)."""
    from ludica.operators.clean import dedupe
    return dedupe(raw_games(spark, sf_dir))


_ANALYSIS: dict[tuple[str, str], str] = {}


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis table: the deduplicated catalogue, written once per
    session as Parquet under the shared checkpoint folder (persisted after
    the dedupe, so the analyses do not each repeat its shuffle and their
    filters and projections reach a plain Parquet scan)."""
    from ludica.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir)
    path = _ANALYSIS.get(key)
    if path is None:
        path = scratch_path(spark, "analysis-games")
        deduped_games(spark, sf_dir).write.parquet(path)
        _ANALYSIS[key] = path
    return load_games(spark, path)
