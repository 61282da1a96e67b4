import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from docquarry.settings import local_session

    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def plan_of(capsys):
    """The physical plan of a frame as text."""

    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text
