import datetime as dt
import time
from pathlib import Path

import pytest

from sieveframe.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shuffle_files(spark):
    """Names of the shuffle files on disk; with ``unlike`` those that stay beside them."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def names(unlike=None):
        if unlike is not None:  # files are removed a moment after the step has ended
            end = time.monotonic() + 5
            while time.monotonic() < end and names() - unlike:
                time.sleep(0.1)
        found = {p.name for d in manager.localDirsString() for p in Path(d).rglob("shuffle_*")}
        return found - (unlike or set())

    return names


CLAIM_COLUMNS = (
    "incident_date timestamp_ntz, incident_state string, incident_type string, "
    "incident_severity string, total_claim_amount long, injury_claim long, "
    "property_claim long, vehicle_claim long, fraud_reported boolean"
)


@pytest.fixture
def make_claims(spark):
    """Every day a hail claim of 1200 (every other one fraud) and one of 300 in Texas,
    and a fraudulent rollover of 7000 in Utah; the first day is a Monday."""

    def make(days, extra=()):
        rows = []
        for i in range(days):
            when = dt.datetime(2019, 3, 4) + dt.timedelta(days=i, hours=i % 24)
            rows += [
                (when, "TX", "Hail", "Major Damage", 1200, 0, 1200, 0, i % 2 == 0),
                (when, "UT", "Rollover", "Total Loss", 7000, 2000, 1000, 4000, True),
                (when, "TX", "Hail", "Trivial Damage", 300, 0, 300, 0, False),
            ]
        return spark.createDataFrame([*rows, *extra], CLAIM_COLUMNS)

    return make


def values(df, name, *order):
    rows = df.orderBy(*order) if order else df
    return [row[name] for row in rows.collect()]
