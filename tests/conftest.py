import pytest

from daybeat.session import configure
from tests.compare import session


@pytest.fixture(scope="session")
def spark():
    spark = configure(session())
    yield spark
    spark.stop()
