import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripweave import build_session  # noqa: E402
from tripweave.schemas import TRIP_SCHEMA  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def make_trips(spark):
    """Trips from dicts; fields left out are NULL."""

    def build(*rows):
        data = [tuple(r.get(f) for f in TRIP_SCHEMA.fieldNames()) for r in rows]
        return spark.createDataFrame(data, TRIP_SCHEMA)

    return build


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(map(repr, r)))
