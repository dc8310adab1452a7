import pytest

from freshet.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle=2, memory="4g")
    yield session
    session.stop()
