"""Command line front end (in-process: reuses the test session)."""

import os
import tempfile

from ludica.__main__ import main
from tests.conftest import SF_SMALL


def test_list_and_run(spark, capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "welch_platform" in out and "ingest_stream" in out
    assert main(["run", "welch_platform", "--sf-dir", SF_SMALL, "--explain"]) == 0
    out = capsys.readouterr().out
    assert "F_statistic" in out and "Physical Plan" in out
    assert main(["run", "no_such_query", "--sf-dir", SF_SMALL]) == 2


def test_ingest_files(spark):
    root = tempfile.mkdtemp(prefix="ludica-cli-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    with open(os.path.join(src, "m.txt"), "w") as f:
        f.write('{"data":"{\\"AppID\\":\\"1\\",\\"Peak CCU\\":\\"5\\"}"}\n{"data":"close"}\n')
    out = os.path.join(root, "out")
    assert main(["ingest", "--files", src, "--out", out]) == 0
    rows = spark.read.parquet(out).collect()
    assert [(r.appID, r.peakCCU) for r in rows] == [("1", 5)]
    # a second run with more files appends
    with open(os.path.join(src, "n.txt"), "w") as f:
        f.write('{"data":"{\\"AppID\\":\\"2\\"}"}\n')
    assert main(["ingest", "--files", src, "--out", out]) == 0
    assert sorted(r.appID for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_eight_views(spark, capsys):
    assert main(["views", "--sf-dir", SF_SMALL,
                 "--sql", "SELECT positive AS real_positive, prediction FROM predictions_table"]) == 0
    out = capsys.readouterr().out
    for v in ["correlation_matrix_table", "popularity_table", "anova_platform_table",
              "anova_platform_results_table", "mann_whitney_genre_table",
              "mann_whitney_genre_results", "predictions_table", "rf_predictions_table"]:
        assert v in out
    assert "real_positive" in out
    assert spark.sql("SELECT label, prediction FROM rf_predictions_table").count() > 0
