import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from placeledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "placeledger-tests", "local[4]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows as dicts plus a DDL schema; columns that a row leaves out are NULL."""
    from pyspark.sql.types import StructType

    def build(rows, schema):
        struct = StructType.fromDDL(schema)
        data = [tuple(r.get(f.name) for f in struct.fields) for r in rows]
        return spark.createDataFrame(data, struct)

    return build
