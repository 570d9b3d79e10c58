import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="spark-")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.session.timeZone": "UTC", "spark.local.dir": scratch, "spark.checkpoint.dir": f"file://{scratch}/shared", "spark.ui.showConsoleProgress": "false"}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
