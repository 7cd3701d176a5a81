from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return oracle.session(partitions="4")


@pytest.fixture(scope="session")
def con():
    return oracle.connect(oracle.DATA)


@pytest.fixture(scope="session")
def data(spark):
    from salesmart.sources.bindings import Dataset

    return Dataset(spark, oracle.DATA)
