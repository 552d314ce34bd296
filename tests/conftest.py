import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


EVENT_LOG_DIR = tempfile.mkdtemp(prefix="run-events-", dir="/tmp")


@pytest.fixture(scope="session")
def spark():
    from stratum.plans.report import event_log_conf
    from stratum.session import build_session
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = build_session("stratum-tests", master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "8g",
        **event_log_conf(EVENT_LOG_DIR),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
