from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def claim(spark):
    """Make raw claims rows from a few columns; the others are NULL."""
    from claimflow.schemas import CLAIM_COLUMNS, all_strings

    def make(*rows: dict):
        full = [tuple(r.get(c) for c in CLAIM_COLUMNS) for r in rows]
        return spark.createDataFrame(full, all_strings(CLAIM_COLUMNS))

    return make


def plan_of(df) -> str:
    """The physical plan as text."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
