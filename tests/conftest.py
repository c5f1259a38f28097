from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from aerolake.session import local_session, pin  # noqa: E402

DATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8", "tests", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse"))
    )
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def pinned(spark):
    pin(spark)


@pytest.fixture(scope="session")
def sf_dir():
    return str(DATA / "sf0.01")
