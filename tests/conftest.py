from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from claimlode.session import local_session, ship_package

    session = local_session(
        4,
        "tests",
        **{
            "spark__checkpoint__dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()
