import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harness.check import session  # noqa: E402
from propensight.session import configure  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return configure(session(8))


@pytest.fixture(scope="session")
def small(spark):
    from harness.stage import stage
    return stage(spark, SF)


@pytest.fixture
def at():
    """Naive timestamp from text."""
    return lambda text: dt.datetime.fromisoformat(text)


EVENT_SCHEMA = ("data_date date, id string, event_timestamp timestamp_ntz, event_id bigint, "
                "visit_timestamp timestamp_ntz, event_env string")


@pytest.fixture
def events(spark, at):
    """Rows ``(id, timestamp, event type)`` with cutoff 2024-01-20."""
    def make(rows, cutoff=dt.date(2024, 1, 20)):
        full = [(cutoff, i, at(t), n, None, e) for n, (i, t, e) in enumerate(rows)]
        return spark.createDataFrame(full, EVENT_SCHEMA)
    return make
