import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session
    from reclink.session import configure

    return configure(session("8"))


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression."""
    from pyspark.sql import functions as F

    def value(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    value.lit = F.lit
    return value
