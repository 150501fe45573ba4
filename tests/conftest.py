import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from tablekit.session import get_spark
    with tempfile.TemporaryDirectory(prefix="tablekit-tests-") as shared:
        yield get_spark("local[*]", 8, extra={"spark.checkpoint.dir": shared})
