import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
for path in (ROOT, ROOT / "tools"):
    if str(path) not in sys.path:
        sys.path.insert(0, str(path))

from paths import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sitelens.session import local_session

    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        shuffle_partitions=4,
        **{
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.sql.maxMetadataStringLength": "1000",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """Workspace over the smallest data set."""
    from sitelens.plans.catalog import workspace

    return workspace(spark, SMALL)


@pytest.fixture()
def duck():
    con = duckdb.connect()
    yield con
    con.close()
