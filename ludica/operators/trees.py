"""Tree models as tables (L7, L8): a row for each node, and an evaluator of joins.

``node_table`` takes a fitted tree or forest apart into (tree, node, feature,
threshold, categories, below, above, shares). ``evaluate`` walks all rows down
all trees at once, a level at a time: a join with the node table, which is
broadcast (its size is that of the model, whatever the data), gives each row its next
node. A forest's votes are the sums of its leaves' class shares; the partial
sums of a row are made where its trees were walked, so one row each is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludica.session import scratch_path


def node_table(spark: SparkSession, model) -> DataFrame:
    """The nodes of a fitted tree or forest classifier. Leaves have a NULL feature;
    ``shares`` are the class shares of a node's training rows. A split is
    value <= threshold, or for a categorical feature value in categories, to ``below``."""
    path = scratch_path(spark, "model")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        saved = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        saved = saved.withColumn("tree", F.lit(0))
    leaf, continuous = F.col("leftChild") < 0, F.col("split.numCategories") < 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return saved.select(
        "tree", F.col("id").alias("node"), F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf & continuous, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(~leaf & ~continuous, F.col("split.leftCategoriesOrThreshold")).alias("categories"),
        F.when(~leaf, F.col("leftChild")).alias("below"), F.when(~leaf, F.col("rightChild")).alias("above"),
        F.transform("impurityStats", lambda x: x / total).alias("shares"))


def evaluate(rows: DataFrame, nodes: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """(key, votes, prediction) of each row by the node table: ``votes`` add up the
    class shares of the leaves, ``prediction`` is the first class with the most. Rows that share a key vote together."""
    nodes = nodes.checkpoint()
    steps = nodes.agg(F.count_distinct("tree").alias("trees"), F.max(F.size("shares")).alias("classes")).first()
    walk = rows.select(F.col(key).alias("_key"), F.array(*[F.col(c).cast("double") for c in features]).alias("_values"),
                       F.explode(F.sequence(F.lit(0), F.lit(steps["trees"] - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(_depth(nodes)):
        v = F.get("_values", F.col("feature"))
        low = F.coalesce(v <= F.col("threshold"), F.array_contains("categories", v))
        walk = (walk.join(F.broadcast(nodes.drop("shares")), ["tree", "node"])
                .select("_key", "_values", "tree", F.when(F.col("feature").isNull(), F.col("node"))
                        .when(low, F.col("below")).otherwise(F.col("above")).alias("node")))
    ended = walk.join(F.broadcast(nodes.select("tree", "node", "shares")), ["tree", "node"])
    votes = ended.groupBy("_key").agg(*[F.sum(F.get("shares", F.lit(c))).alias(f"_{c}") for c in range(steps["classes"])])
    votes = votes.select(F.col("_key").alias(key), F.array(*[F.col(f"_{c}") for c in range(steps["classes"])]).alias("votes"))
    return votes.withColumn("prediction", (F.array_position("votes", F.array_max("votes")) - 1).cast("double"))


def _depth(nodes: DataFrame) -> int:
    """Splits on the longest way from a root to a leaf: a round for each level of the table."""
    level, depth = nodes.where("node = 0 AND feature IS NOT NULL").select("tree", "below", "above"), 0
    while not level.isEmpty():
        depth += 1
        children = level.select("tree", F.explode(F.array("below", "above")).alias("node"))
        level = (children.join(F.broadcast(nodes), ["tree", "node"]).where("feature IS NOT NULL")
                 .select("tree", "below", "above"))
    return depth
