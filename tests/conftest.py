"""Shared session; workers find the package through PYTHONPATH."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from boardloom import session

    s = session.build("local[4]", 4, **{"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
