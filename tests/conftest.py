import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from planmart.session import get_session
    s = get_session("local[*]", 8)
    yield s


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="module", autouse=True)
def views_of_a_module_end_with_it(spark):
    yield
    for table in spark.catalog.listTables():
        if table.isTemporary:
            spark.catalog.dropTempView(table.name)
