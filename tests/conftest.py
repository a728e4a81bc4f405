import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cantogram.session import build_session

    session = build_session(
        "cantogram-tests",
        master="local[*]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        # Its own folder: a test that looks for what another session leaves must not find this one's tables.
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('checkpoints')}",
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def plan_of():
    """The optimized or executed plan of a DataFrame as text."""

    def text(df, executed=True):
        qe = df._jdf.queryExecution()
        return (qe.executedPlan() if executed else qe.optimizedPlan()).toString()

    return text


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
