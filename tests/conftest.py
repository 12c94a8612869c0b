import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tideline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Nine hourly rows: one repeated, one with a gap."""
    return spark.sql(
        """
        select timestamp_ntz '2016-07-01 00:00:00' + make_dt_interval(0, h) as date, a as A, b as B, t as OT
        from values (0, 1D, 10D, 5D), (1, 2D, 20D, 6D), (1, 2D, 20D, 6D), (2, null, 10D, 8D), (3, 4D, 30D, 7D),
                    (4, 5D, 20D, 9D), (5, 6D, 10D, 10D), (6, 7D, 40D, 8D), (7, 8D, 20D, 11D) as v(h, a, b, t)
        """
    )
