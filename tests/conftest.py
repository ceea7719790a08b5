import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def day():
    return lambda text: date.fromisoformat(text)


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)
