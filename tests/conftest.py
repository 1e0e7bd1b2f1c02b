from __future__ import annotations

import tempfile

import pytest

from tallyhouse.config import session
from tests.oracle import connect

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", 8, **{"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wh-")})
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(autouse=True)
def no_leftover_cache(request):
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()
