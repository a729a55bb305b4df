import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from flowsight.session import CHECKPOINT_KEY, build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        CHECKPOINT_KEY: str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", master="local[4]", settings=settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def flow_row():
    """A sound row of the flow contract; keyword arguments replace columns."""
    from flowsight.contract import FLOW

    def build(**changes):
        row = {c: 0.0 if FLOW.is_floating(c) else 1 for c in FLOW.numeric}
        row |= {"id": 1, "proto": "tcp", "service": "http", "state": "FIN", "attack_cat": "Normal", "label": 0}
        return tuple({**row, **changes}[c] for c in FLOW.columns)

    return build


@pytest.fixture(scope="session")
def plan_of():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
