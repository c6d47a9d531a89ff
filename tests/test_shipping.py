"""UDF code reaches the workers wherever the process was started."""

import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", {entry!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("levene_platform_test", "anova_platform_results", "tukey_platform_test",
             "mann_whitney_genre_results", "ttest_metacritic_test"):
    print(name, len(entry.queries()[name](spark, {sf!r}).collect()))
"""


def test_p_value_queries_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(entry=os.path.join(ROOT, "__spark_entry__.py"), sf=SF_SMALL)],
                          cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("\n") == 5
