import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from aeolus.session import configure, ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[*]")
         .appName("aeolus-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="aeolus-test-")
