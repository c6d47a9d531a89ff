"""Arrow-batched UDFs that turn test statistics into p-values.

They are applied to the small result frames of ``ludica.operators.stats``
(one row per test, group or group pair), never to data rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludica.functions import special


def _none(x):
    return None if x is None or pd.isna(x) else x


@F.pandas_udf(T.DoubleType())
def t_test_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([special.t_two_sided_p(_none(a), _none(b)) for a, b in zip(t, df)],
                     dtype="float64")


@F.pandas_udf(T.DoubleType())
def f_test_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([special.f_sf(_none(a), _none(b), _none(c)) for a, b, c in zip(f, d1, d2)],
                     dtype="float64")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def tukey_cell(cell: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    """Tail polynomial of a cell of the studentized range."""
    out = []
    for a, b, c in zip(cell, k, df):
        b, c = _none(b), _none(c)
        out.append(None if b is None or c is None else special.studentized_range_cell(int(a), int(b), float(c)))
    return pd.Series(out, dtype="object")


@F.pandas_udf(T.DoubleType())
def tukey_qcrit(alpha: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    out = []
    for a, b, c in zip(alpha, k, df):
        a, b, c = _none(a), _none(b), _none(c)
        ok = a is not None and b is not None and c is not None
        out.append(special.studentized_range_ppf(1.0 - a, int(b), float(c)) if ok else None)
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def mwu_p(u1: pd.Series, n1: pd.Series, n2: pd.Series, tie_term: pd.Series) -> pd.Series:
    out = []
    for u, a, b, t in zip(u1, n1, n2, tie_term):
        u, a, b, t = _none(u), _none(a), _none(b), _none(t)
        ok = u is not None and a is not None and b is not None
        out.append(special.mwu_two_sided_p(u, int(a), int(b), t or 0.0) if ok else None)
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def mwu_tied_p(u1: pd.Series, n1: pd.Series, n2: pd.Series, cums: pd.Series) -> pd.Series:
    """Exact p given the tie groups; NULL where they are not listed."""
    out = []
    for u, a, b, ends in zip(u1, n1, n2, cums):
        known = ends is not None and len(ends) and _none(u) is not None
        out.append(special.mwu_tied_two_sided_p(u, int(a), int(b), ends.tolist()) if known else None)
    return pd.Series(out, dtype="float64")
