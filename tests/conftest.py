import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratamart.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Every join side counts as too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    yield
    spark.conf.set(name, before)


def rows(df, *order):
    """Rows as sorted tuples."""
    names = order or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.collect()),
                  key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
