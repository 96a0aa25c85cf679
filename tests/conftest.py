import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = os.environ.get("MERCATO_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from mercato.session import apply_semantics, ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[4]").appName("mercato-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="mercato-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_semantics(s)
    ensure_checkpoint_dir(s)  # unset in tests: a fresh scratch folder
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
