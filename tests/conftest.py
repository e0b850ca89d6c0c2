import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tulha.session import local_session

    shared = f"file://{tmp_path_factory.mktemp('shared')}"
    return local_session(8, "tests", **{"spark.checkpoint.dir": shared})


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
