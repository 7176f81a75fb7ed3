"""Settings that the operators of this package make do not stay in the session of the other tests."""

from __future__ import annotations

import pytest

from goldenlake.llm.common import SESSION_CONF


@pytest.fixture(autouse=True, scope="module")
def settings_of_the_package(spark):
    before = {key: spark.conf.get(key, None) for key in SESSION_CONF}
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
