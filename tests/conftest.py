from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from goldenlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "goldenlake-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    def text(df, executed: bool = False) -> str:
        if executed:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def set_conf(spark):
    """Change session settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
