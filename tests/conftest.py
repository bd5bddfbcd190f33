import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(autouse=True)
def whole_plans(request):
    """Plans are read whole, whatever queries before have set."""
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.unset("spark.sql.maxPlanStringLength")
