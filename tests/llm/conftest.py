import pytest

from slicewright.llm.common import send_package


@pytest.fixture(scope="session", autouse=True)
def package_sent(spark):
    send_package(spark)
