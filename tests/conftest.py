import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hourcast.session import checkpoint_dir, local_session

START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    checkpoint_dir(session)
    return session


def at(hours: float) -> datetime:
    return START + timedelta(hours=hours)


def key_rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
