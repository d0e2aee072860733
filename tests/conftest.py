import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vernissage.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", 4, spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one row of the given columns."""

    def value(expr, schema="s string", *row):
        return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]

    return value


def utc(*a):
    return dt.datetime(*a, tzinfo=dt.UTC)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
