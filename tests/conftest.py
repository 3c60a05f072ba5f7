import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from check import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    out = session(4)
    if out.conf.get("spark.checkpoint.dir", None) is None:
        out.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stage")))
    yield out
    out.stop()
