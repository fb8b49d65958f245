"""Shared session and fixtures."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TIDEMARK_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from tests.oracle import connect

    return connect(sf_dir)


def rows(df, *order):
    """Collected rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
