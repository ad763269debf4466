from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from playlens.session import local_session

    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "playlens-tests",
        "4",
        **{
            "spark.checkpoint.dir": str(base / "checkpoint"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return "/root/testdata/sf0.001"
