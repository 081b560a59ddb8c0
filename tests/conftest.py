import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from tidemart.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(name="tests")


@pytest.fixture(scope="session")
def warehouse(spark):
    """All datasets lazily over the smallest driver tables."""
    from tidemart.plans.catalogue import tables

    return tables(spark, SMALL)


@pytest.fixture(scope="session")
def saved(spark, tmp_path_factory):
    """All datasets saved by a full run over the smallest driver tables."""
    from tidemart.plans.warehouse import run_all
    from tidemart.sources.driver_tables import DriverTables

    return run_all(spark, DriverTables(spark, SMALL).bronze, str(tmp_path_factory.mktemp("warehouse")))
