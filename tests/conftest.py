from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from texloom.session import local_session
    s = local_session(cores="*", app="texloom-tests", extra={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A new folder under the session's checkpoint folder (never reused)."""
    from texloom.plans.archive_fixture import shared_scratch
    return shared_scratch(spark, "test")


def local_path(uri: str) -> str:
    return uri[len("file://"):] if uri.startswith("file://") else uri


def one_col(df, name):
    return [r[name] for r in df.collect()]
