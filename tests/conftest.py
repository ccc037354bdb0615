import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="cadenza-tests", shuffle_partitions=4, conf={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
