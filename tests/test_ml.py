"""Models: regression equals least squares; forests are reproducible."""

import numpy as np
import pytest

from ludica.plans import analyses as A
from tests.conftest import SF_CHECK


def test_regression_matches_lstsq(spark):
    rows = A.regression_rows(spark, SF_CHECK).toPandas()
    x = rows[A.POLY_INPUTS].to_numpy(float)
    r, n, p = x[:, 0], x[:, 1], x[:, 2]
    design = np.column_stack([r, r * r, n, r * n, n * n, p, r * p, n * p, p * p, np.ones(len(r))])
    coef, *_ = np.linalg.lstsq(design, rows.positive.to_numpy(float), rcond=None)
    s = A.QUERIES["regression_summary"](spark, SF_CHECK).first()
    fitted = design @ coef
    assert s.intercept == pytest.approx(coef[-1], rel=1e-6, abs=1e-6)
    assert np.allclose(s.coefficients, coef[:-1], rtol=1e-6, atol=1e-8)
    y = rows.positive.to_numpy(float)
    assert s.mse == pytest.approx(np.mean((y - fitted) ** 2), rel=1e-6, abs=1e-9)


def test_forest_is_reproducible(spark):
    a = A.QUERIES["forest_accuracy"](spark, SF_CHECK).first()
    b = A.QUERIES["forest_accuracy"](spark, SF_CHECK).first()
    assert a.accuracy == b.accuracy and 0.0 <= a.accuracy <= 1.0


def test_confusion_covers_label_grid(spark):
    c = A.QUERIES["confusion"](spark, SF_CHECK).collect()
    assert [r.label_name for r in c] == ["Low", "Medium", "High"]
    total = sum(r.predicted_Low + r.predicted_Medium + r.predicted_High for r in c)
    assert total == A.QUERIES["forest_accuracy"](spark, SF_CHECK).first().n


def test_confusion_of_absent_classes(spark):
    from ludica.operators.ml import confusion
    pred = spark.createDataFrame([(0, 1.0), (2, 1.0), (2, 2.0), (None, 1.0), (0, None)], "label int, prediction double")
    assert [tuple(r) for r in confusion(pred, [0, 1, 2], ["L", "M", "H"]).collect()] == [
        (0, "L", 0, 1, 0), (1, "M", 0, 0, 0), (2, "H", 0, 1, 1)]


def test_poly_feature_order(spark):
    from ludica.operators.ml import poly_names
    assert poly_names(["x", "y", "z"]) == ["x", "x_sq", "y", "x_x_y", "y_sq", "z", "x_x_z",
                                           "y_x_z", "z_sq"]
