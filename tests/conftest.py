from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from compare import DATA, local_session, oracle  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session()
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture(scope="session")
def folder() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def duck(folder):
    return oracle(folder)


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples."""

    def collect(df, *order):
        out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
        return out if order else sorted(out, key=repr)

    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
