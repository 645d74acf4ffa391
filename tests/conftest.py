import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lineloom.session import local_session, unstage  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    unstage(session)
    session.stop()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(spark, **contents):
    pairs = [(name.replace("__", "."), content) for name, content in contents.items()]
    return spark.createDataFrame(pairs, "file_path string, content string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
