import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from recengine.session import ensure_checkpoint_dir, get_session

    s = get_session(master="local[4]", app="recengine-tests", shuffle_partitions=4,
                    extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
