import json
import os
import sys
from glob import glob

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from foldergrid.session import local_session

    shared = tmp_path_factory.mktemp("shared")  # removed by pytest
    (shared / "events").mkdir()
    session = local_session(8, 4, **{
        "spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse"),
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{shared}/events", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.buffer.kb": "16k",
    })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def plans_of(spark):
    """Runs something and returns the plans of all jobs that ran meanwhile, by Spark's event log."""
    [log] = glob(spark.conf.get("spark.checkpoint.dir") + "/events/*")

    def plans(run):
        bus = spark.sparkContext._jsc.sc().listenerBus()
        bus.waitUntilEmpty(30_000)
        with open(log) as lines:
            lines.seek(0, os.SEEK_END)
            result = run()
            bus.waitUntilEmpty(30_000)
            found = [json.loads(line)["physicalPlanDescription"] for line in lines if '"physicalPlanDescription"' in line]
        return result, found

    return plans


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
