import pytest

from feedworks.llm.common import ship_code


@pytest.fixture(scope="session", autouse=True)
def shipped_code(spark):
    ship_code(spark)
