import os
import sys
from datetime import date, datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from testbed.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples of the given columns."""
    def collect(df, *columns):
        return sorted([tuple(r) for r in df.select(*(columns or df.columns)).collect()],
                      key=lambda t: tuple((v is None, str(v)) for v in t))
    return collect


@pytest.fixture
def price_hours(spark):
    """Zone prices of some hours counted from 2024-01-01, as `{zone: {hour: price}}`."""
    def build(series):
        start = datetime(2024, 1, 1)
        data = []
        for zone, values in series.items():
            for hour, price in values.items():
                at = start + timedelta(hours=hour)
                data.append((at.date(), at, zone, price))
        return spark.createDataFrame(
            data, "date date, timestamp timestamp, zone string, price_eur_mwh double")
    return build


@pytest.fixture
def day():
    return date.fromisoformat
