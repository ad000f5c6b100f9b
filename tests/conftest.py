import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from homeload.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of dicts with a DDL schema, missing fields null."""

    def make(rows, schema):
        from pyspark.sql import types as T

        fields = T.StructType.fromDDL(schema)
        return spark.createDataFrame([{f.name: r.get(f.name) for f in fields} for r in rows], fields)

    return make
