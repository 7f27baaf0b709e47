from __future__ import annotations

import pytest

from demandloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
