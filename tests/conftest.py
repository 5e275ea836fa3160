import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from loomset.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Value of an expression over named text columns of one row."""

    def value(make, **cols):
        from pyspark.sql import functions as F

        row = spark.createDataFrame([tuple(cols.values())], list(cols))
        return row.select(make(*[F.col(c) for c in cols]).alias("v")).first()["v"]

    return value
