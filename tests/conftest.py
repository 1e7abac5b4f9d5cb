import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from textgate.session import get_spark

    s = get_spark("local[4]", app="textgate-tests", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="textgate-test-ckpt-"),
    })
    yield s
    s.stop()
