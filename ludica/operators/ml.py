"""Models of the analysis (L1, L3-L10) on ``pyspark.ml``.

Fits are Spark ML estimators (distributed, iterative jobs). What reaches
the driver is bounded by the number of features: coefficients, importances,
summary metrics. Predictions, accuracy and the confusion matrix stay lazy
DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """L1: numeric columns into one vector; NULL raises (``error``) or drops
    the row (``skip``)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def poly_expand(df: DataFrame, in_col: str = "features", out: str = "poly_features",
                degree: int = 2) -> DataFrame:
    """L3: polynomial expansion (for (x, y, z), degree 2:
    x, x^2, y, xy, y^2, z, xz, yz, z^2)."""
    return PolynomialExpansion(inputCol=in_col, outputCol=out, degree=degree).transform(df)


def poly_names(cols: Sequence[str], degree: int = 2) -> list[str]:
    """Names of the degree-2 expansion terms in PolynomialExpansion order."""
    if degree != 2:
        raise ValueError("names are provided for degree 2 only")
    names: list[str] = []
    for i, c in enumerate(cols):
        names.append(c)
        for p in cols[:i]:
            names.append(f"{p}_x_{c}")
        names.append(f"{c}_sq")
    return names


def poly_columns(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """L3 as plain DOUBLE columns (for inspection and SQL comparison)."""
    v = poly_expand(assemble(df, cols, "_f"), "_f", "_p")
    arr = vector_to_array(F.col("_p"))
    names = poly_names(cols)
    return v.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])


def fit_regression(df: DataFrame, features: str, label: str, **params):
    """L4: least squares (Spark defaults: no regularisation, normal equations
    for few features)."""
    return LinearRegression(featuresCol=features, labelCol=label, **params).fit(df)


def regression_summary(model, spark) -> DataFrame:
    """r2, MAE, MSE, RMSE on the training data, intercept, coefficients."""
    s = model.summary
    row = (float(s.r2), float(s.meanAbsoluteError), float(s.meanSquaredError),
           float(s.rootMeanSquaredError), float(model.intercept),
           [float(c) for c in model.coefficients.toArray()], int(s.numInstances))
    return spark.createDataFrame(
        [row], "r2 double, mae double, mse double, rmse double, intercept double, "
               "coefficients array<double>, n long")


def predictions(model, df: DataFrame, label: str, real_name: str = "real_positive") -> DataFrame:
    """(real label, prediction)."""
    return model.transform(df).select(F.col(label).alias(real_name), "prediction")


def fit_tree(train: DataFrame, features: str = "features", label: str = "label",
             seed: int = 1234, **params):
    """Decision tree classifier."""
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, seed=seed,
                                  **params).fit(train)


def fit_forest(train: DataFrame, features: str = "features", label: str = "label",
               num_trees: int = 20, seed: int = 1234, **params):
    """Random forest classifier (20 trees by default)."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees,
                                  seed=seed, **params).fit(train)


def importances(model, feature_names: Sequence[str], spark) -> DataFrame:
    """Feature importances as rows (one per feature)."""
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(imp[i])) for i, n in enumerate(feature_names)],
                                 "feature string, importance double")


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows with prediction == label, as a lazy one-row frame."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return pred.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def accuracy_value(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """L9 through Spark's evaluator (what the analysis called)."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                           metricName="accuracy")
    return ev.evaluate(pred)


def confusion(pred: DataFrame, classes: Sequence[int], names: Sequence[str],
              label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per class as the true label, one count column per class as
    the prediction: the whole grid, zeros included, in one aggregate of
    classes x classes conditional counts."""
    true, said = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = pred.agg(*[F.count_if((true == a) & (said == b)).alias(f"_{i}_{j}")
                        for i, a in enumerate(classes) for j, b in enumerate(classes)])
    rows = [F.struct(F.lit(a).alias("label"), F.lit(names[i]).alias("label_name"),
                     *[F.col(f"_{i}_{j}").alias(f"predicted_{n}") for j, n in enumerate(names)])
            for i, a in enumerate(classes)]
    return counts.select(F.inline(F.array(*rows)))
