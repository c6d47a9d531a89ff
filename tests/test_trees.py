from pyspark.sql import functions as F

from ludica.operators import ml, trees

INPUTS = ["a", "b", "kind"]


def _rows(spark):
    x = F.rand(1)
    df = spark.range(600).select(F.col("id").cast("string").alias("k"), x.alias("a"), F.rand(2).alias("b"),
                                 (F.col("id") % 4).cast("double").alias("kind"))
    return df.withColumn("label", F.when(F.col("kind").isin(1.0, 2.0), F.when(F.col("a") > 0.5, 2).otherwise(0))
                         .otherwise(F.when(F.col("b") > 0.3, 1).otherwise(0)).cast("double"))


def _walk(nodes, tree, values):
    at = 0
    while (n := nodes[tree, at])["feature"] is not None:
        v = values[n["feature"]]
        at = n["below"] if (v in n["categories"] if n["categories"] is not None else v <= n["threshold"]) else n["above"]
    return n["shares"]


def test_walk_equals_the_model_and_a_plain_walk(spark):
    """Continuous and categorical splits, one tree and many; a table of rows of which some share a key."""
    from pyspark.ml.feature import VectorIndexer
    rows = _rows(spark)
    data = ml.assemble(rows, INPUTS)
    indexed = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=4).fit(data).transform(data)
    for model in (ml.fit_tree(indexed, features="indexed"), ml.fit_forest(indexed, features="indexed", num_trees=5)):
        table = trees.node_table(spark, model)
        nodes = {(n["tree"], n["node"]): n for n in table.collect()}
        assert any(n["categories"] is not None for n in nodes.values()) and any(n["threshold"] is not None for n in nodes.values())
        said = {r["k"]: r["prediction"] for r in model.transform(indexed).collect()}
        values = {r["k"]: [r[c] for c in INPUTS] for r in rows.collect()}
        got = trees.evaluate(rows, table, INPUTS, "k").collect()
        assert len(got) == 600 and {r["k"]: r["prediction"] for r in got} == said
        n_trees = 1 + max(t for t, _ in nodes)
        for r in got[:50]:
            want = [sum(x) for x in zip(*(_walk(nodes, t, values[r["k"]]) for t in range(n_trees)))]
            assert all(abs(a - b) < 1e-9 for a, b in zip(r["votes"], want, strict=True))


def test_a_single_leaf_and_no_rows(spark):
    data = ml.assemble(spark.createDataFrame([("x", 1.0, 0.0), ("y", 2.0, 0.0)], "k string, a double, label double"), ["a"])
    table = trees.node_table(spark, ml.fit_tree(data))
    assert table.count() == 1
    assert {r["k"]: r["prediction"] for r in trees.evaluate(data, table, ["a"], "k").collect()} == {"x": 0.0, "y": 0.0}
    assert trees.evaluate(data.limit(0), table, ["a"], "k").collect() == []
