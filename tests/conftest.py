import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from sigilgraph.session import local_session

    session = local_session(4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """Rows to a DataFrame with a schema text."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
