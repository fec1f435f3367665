import os
import sys
import warnings

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
warnings.filterwarnings("ignore")


@pytest.fixture(scope="session")
def spark():
    from firstprint.session import local_session
    session = local_session("tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate named columns on one row of literals."""
    def run(row: dict, **columns):
        schema = ", ".join(f"{k} string" for k in row)
        df = spark.createDataFrame([tuple(row.values())], schema)
        return df.select(*[c.alias(n) for n, c in columns.items()]).first()
    return run
