from __future__ import annotations

import pytest

from measurekit.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write(tmp_path):
    def _write(text: str, name: str = "input.csv") -> str:
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return _write
