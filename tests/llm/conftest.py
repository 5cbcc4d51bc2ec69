import pytest

from planmart.llm.common import importable


@pytest.fixture(scope="session")
def session(spark):
    """The tests' session, with this repository on the path of its Python workers."""
    return importable(lambda s: s)(spark)
