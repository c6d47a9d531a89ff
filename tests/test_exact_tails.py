"""Exact Mann-Whitney tails given ties, and the table of the studentized range."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludica.functions import special
from ludica.operators import stats

SAMPLES = "s string, g string, v double"


def _enumerated(a, b):
    """Two-sided p over all ways to draw the first sample from the pooled values."""
    pool = sorted(a + b)
    doubled = [2 * np.mean([i + 1 for i, y in enumerate(pool) if y == x]) for x in pool]
    seen = sum(doubled[pool.index(x)] for x in a)
    sums = [sum(c) for c in itertools.combinations(doubled, len(a))]
    high, low = (np.mean([s >= seen - 1e-9 for s in sums]), np.mean([s <= seen + 1e-9 for s in sums]))
    return min(1.0, 2 * min(high, low))


def _cums(values):
    return np.cumsum(np.unique(values, return_counts=True)[1]).tolist()


@pytest.mark.parametrize("a,b", [([1, 2, 2], [2, 3, 3, 4]), ([1, 1, 5, 5], [1, 5]), ([3, 3, 3], [3, 3]), ([9], [1, 1, 2, 9, 9]),
                                 ([1, 2, 3, 4, 5], [6, 7, 8])])
def test_tied_p_against_enumeration(a, b):
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    got = special.mwu_tied_two_sided_p(u, len(a), len(b), _cums(a + b))
    assert got == pytest.approx(_enumerated(a, b), abs=1e-12)
    assert special.mwu_tied_two_sided_p(len(a) * len(b) - u, len(b), len(a), _cums(a + b)) == pytest.approx(got, abs=1e-12)


def test_without_ties_it_is_the_partition_count():
    for u in (0, 7, 20, 33.0):
        assert special.mwu_tied_two_sided_p(u, 6, 9, list(range(1, 16))) == pytest.approx(
            special.mwu_two_sided_p(u, 6, 9, 0.0), abs=1e-12)


def test_the_distribution_sums_to_one_for_large_binomials():
    p = special.rank_sum_distribution(50, [40, 60, 100])
    assert p.sum() == pytest.approx(1.0, abs=1e-12) and p.min() >= 0.0


def test_strata(spark):
    rng = np.random.default_rng(5)
    data = {None: ([1.0, 2.0, 2.0], [2.0, 3.0]), "x": ([4.0, 4.0], [4.0]), "only": ([1.0, 2.0], []),
            "hot": (rng.integers(0, 9, 120).astype(float).tolist(), rng.integers(1, 9, 90).astype(float).tolist()),
            "plain": (rng.random(5).tolist(), rng.random(200).tolist()), "nan": ([1.0, math.nan], [2.0])}
    rows = [(s, g, v) for s, both in data.items() for g, vs in zip("ab", both) for v in vs]
    rows += [("x", "c", 1.0), ("x", None, 1.0), ("x", "a", None)]
    df = spark.createDataFrame(rows, SAMPLES).select("s", F.col("g").alias("_na"), F.col("v").alias("_n"))
    got = {r.s: r for r in stats.mann_whitney_by(df, "_n", "_na", "a", "b", ["s"]).collect()}
    assert set(got) == set(data)
    assert {s: r.method for s, r in got.items()} == {None: "exact", "x": "exact", "only": None, "hot": "asymptotic", "plain": "exact", "nan": None}
    for s in (None, "x"):
        assert got[s].P_value == pytest.approx(_enumerated(*data[s]))
    for s in ("hot", "plain"):
        one = stats.mann_whitney(df.where(F.col("s") == s), "_n", "_na", "a", "b").first()
        assert (got[s].U_statistic, got[s].n_first, got[s].n_second, got[s].tie_term) == tuple(one)[:4]
        assert got[s].P_value == pytest.approx(one.P_value, abs=1e-12)
    assert got["only"].P_value is None and got["nan"].P_value is None and got["only"].n_first == 2
    assert stats.mann_whitney_by(df.limit(0), "_n", "_na", "a", "b", ["s"]).count() == 0


def _ways(m, cums):
    """Ways to draw ``m`` values by twice their midrank sum, in whole numbers."""
    ways, below = {(0, 0): 1}, 0
    for cum in cums:
        t, doubled, step = cum - below, below + cum + 1, {}
        for (j, s), w in ways.items():
            for c in range(min(t, m - j) + 1):
                at = (j + c, s + c * doubled)
                step[at] = step.get(at, 0) + w * math.comb(t, c)
        ways, below = step, cum
    return {s: w for (j, s), w in ways.items() if j == m}


@pytest.mark.parametrize("m,cums", [(3, [1, 3, 4, 9, 10]), (1, [2, 5]), (5, [5]), (4, [1, 2, 3, 4]), (0, [3]), (7, list(range(1, 31))),
                                    (45, [10, 11, 60, 61, 62, 100]), (3, [400, 401, 1200])])
def test_the_distribution_up_to_a_sum(m, cums):
    ways, n = _ways(m, cums), cums[-1]
    p = special.rank_sum_distribution(m, cums)
    assert max(ways) < len(p)
    for s in range(len(p)):
        assert p[s] == pytest.approx(ways.get(s, 0) / math.comb(n, m), rel=1e-10, abs=0)
    for top in (0, min(ways), (min(ways) + max(ways)) // 2, max(ways) + 5):
        assert special.rank_sum_distribution(m, cums, top).tolist() == p[:top + 1].tolist()


def test_both_tails_keep_their_precision():
    rng = np.random.default_rng(3)
    for m, n, distinct in ((40, 100, 7), (50, 100, 10 ** 6), (3, 20, 5), (17, 20, 5), (8, 21, 12)):
        v = rng.integers(0, distinct, n)
        cums, ways = _cums(v), _ways(m, _cums(v))
        for s in sorted(ways)[::max(1, len(ways) // 9)]:
            low, high = sum(w for x, w in ways.items() if x <= s), sum(w for x, w in ways.items() if x >= s)
            got = special.mwu_tied_two_sided_p(s / 2 - m * (m + 1) / 2, m, n - m, cums)
            assert got == pytest.approx(min(1.0, 2 * min(low, high) / math.comb(n, m)), rel=1e-9)


def test_counts_of_partitions():
    for m in (1, 3, 5):
        ways = [1] + [0] * 200               # numbers 0..200 as sums of parts of at most m
        for part in range(1, m + 1):
            for t in range(part, 201):
                ways[t] += ways[t - part]
        assert [special._partitions_up_to(t, m) for t in range(-1, 201)] == [0, *np.cumsum(ways).tolist()]


def _strata(spark):
    rng = np.random.default_rng(9)
    sizes = {None: 60, 0: 12, 1: 61, 2: 400, 4: 160, 5: 500, 6: 400}
    rows = [(s, "abc"[int(g)], float(v)) for s, n in sizes.items() for g, v in zip(rng.integers(0, 3, n), rng.integers(0, 30, n))]
    rows += [(6, "a", math.nan), (0, "a", None), (0, None, 1.0), (7, "c", 1.0), (0, "b", -0.0), (0, "a", 0.0)]
    rows += [(8, "ab"[i > 4], float(i)) for i in range(150)]
    return spark.createDataFrame(rows, "s int, g string, v double").repartition(5)


def test_strata_have_the_same_rows_in_one_task_and_by_value_ranges(spark, monkeypatch):
    rows = []
    for small in (stats.EXACT_ITEMS, 200, 10_000):
        monkeypatch.setattr(stats, "SMALL_STRATUM", small)
        rows.append({r.s: r for r in stats.mann_whitney_by(_strata(spark), "v", "g", "a", "b", ["s"]).collect()})
    assert set(rows[0]) == {None, 0, 1, 2, 4, 5, 6, 8} and rows[0] == rows[1] == rows[2]
    assert [rows[0][s].method for s in (None, 0, 1, 2, 5, 6, 8)] == ["exact", "exact", "exact", "asymptotic", "asymptotic", None, "exact"]


def test_strata_are_dealt_over_all_partitions_and_tested_once(spark, monkeypatch):
    out = stats.mann_whitney_by(_strata(spark), "v", "g", "a", "b", ["s"])
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a listed stratum comes to the p-value of the larger ones without its statistic
    monkeypatch.setattr(stats.pvalues, "mwu_tied_p", lambda *_: F.lit(None).cast("double"))
    monkeypatch.setattr(stats.pvalues, "mwu_p", lambda u, *_: F.when((F.col(u) if isinstance(u, str) else u).isNotNull(), F.lit(1.0)))
    got = stats.mann_whitney_by(_strata(spark), "v", "g", "a", "b", ["s"]).collect()
    assert {r.s for r in got if r.P_value is not None} == {2, 5, 8}


@pytest.mark.parametrize("k,df", [(2, 3), (3, 10), (5, 14995), (12, 40), (200, 1e6), (4, 1.5)])
def test_the_table_is_within_its_error(k, df):
    for cell in (0, 5, 17, 40, 52, 60, 75, 110):
        poly = special.studentized_range_cell(cell, k, df)
        for u in np.linspace(-1, 1, 7):
            q = math.expm1((cell + 0.5 + 0.5 * u) / special.RANGE_CELLS)
            assert np.polynomial.polynomial.polyval(u, poly) == pytest.approx(special.studentized_range_sf(q, k, df), abs=1e-9)


def test_rows_get_their_tail_from_the_table(spark):
    rows = [(q, float(k), df) for q in (0.0, 0.4, 3.3, 3.4, 900.0) for k, df in ((3, 10.0), (7, 55.5))]
    rows += [(None, 3.0, 10.0), (2.0, 3.0, 0.0), (2.0, None, 9.0)]
    got = stats.with_range_tail(spark.createDataFrame(rows, "q double, _k double, _df double")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.q is None or r["_k"] is None or not r["_df"]:
            assert r.p_adj is None
        else:
            assert r.p_adj == pytest.approx(special.studentized_range_sf(r.q, int(r["_k"]), r["_df"]), abs=1e-9)
            assert r["_qc"] == pytest.approx(special.studentized_range_ppf(0.95, int(r["_k"]), r["_df"]))
