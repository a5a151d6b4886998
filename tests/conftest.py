import pytest

from termweave.session import tune
from tests.session import local_session

# Tiny inputs: interpreting a plan takes less time than compiling and re-planning it.
INTERPRETED = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.shuffle.partitions": "2",
    "spark.sql.codegen.wholeStage": "false",
    "spark.sql.codegen.factoryMode": "NO_CODEGEN",
}


@pytest.fixture(scope="session")
def session():
    session = tune(local_session())
    yield session
    session.stop()


@pytest.fixture(scope="session")
def spark(session):
    """A session for small fixtures."""
    small = session.newSession()
    for name, value in INTERPRETED.items():
        small.conf.set(name, value)
    return small


@pytest.fixture(scope="session")
def compiled(session):
    """A session as queries run in it."""
    return session
