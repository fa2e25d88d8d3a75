import pytest


@pytest.fixture(scope="session")
def spark():
    from sigilgraph.session import local_session

    session = local_session(4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session
