import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quotelake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="quotelake-tests-")
    s = build_session("local[*]", "quotelake-tests", 8, **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": ckpt,
        "spark.driver.memory": "4g",
    })
    yield s
    from quotelake.session import release_run_dirs
    release_run_dirs(s)
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="quotelake-t-")
