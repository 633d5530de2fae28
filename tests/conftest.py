import pytest

from flankspark.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "4g", spark__sql__shuffle__partitions="4")
