"""One local session for all tests."""

import pytest

from millrace.session import build


@pytest.fixture(scope="session")
def spark():
    session = build("tests", cores=4, shuffle=4, driver_memory="4g")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    yield session
    session.stop()
