import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from arcash.session import get_session
    ckpt = tempfile.mkdtemp(prefix="arcash-test-ckpt-")
    s = get_session(master="local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()
