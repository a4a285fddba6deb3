import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattlake.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "wattlake-tests", "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


MIX_PAYLOAD = {
    "zone": "AT", "temporalGranularity": "hourly", "unit": "MW",
    "data": [{
        "datetime": "2026-05-14T16:00:00+02:00", "updatedAt": "2026-05-14T19:05:10.250+02:00",
        "isEstimated": False, "estimationMethod": "OWN_TEST_VALUES",
        "mix": {
            "hydro": 3875, "wind": 2210.75, "nuclear": 1200.5, "solar": 985.5, "gas": 640.5, "biomass": 410.0,
            "coal": 15.25, "oil": 8, "hydro storage": {"charge": None, "discharge": 512.25},
            "battery storage": {"charge": 6.5, "discharge": None}, "flows": {"imports": 905, "exports": 1450.5},
        },
    }],
}
FLOWS_PAYLOAD = {
    "zone": "AT", "temporalGranularity": "hourly", "unit": "MW",
    "data": [{
        "datetime": "2026-05-14T16:00:00+02:00", "updatedAt": "2026-05-14T19:05:10.250+02:00",
        "import": {"DE": 702.5, "CZ": 150}, "export": {"CH": 480, "SI": 95.25},
    }],
}


@pytest.fixture
def mix_payload():
    import copy
    return copy.deepcopy(MIX_PAYLOAD)


@pytest.fixture
def flows_payload():
    import copy
    return copy.deepcopy(FLOWS_PAYLOAD)
