import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from salesmart.session import get_session
    spark = get_session("local[4]", app="salesmart-tests", shuffle_partitions=8)
    yield spark
    spark.stop()


@pytest.fixture()
def workdir():
    """A fresh folder per test (tests run on one machine)."""
    return tempfile.mkdtemp(prefix="salesmart-test-")


def plan_text(df, mode="formatted"):
    """The plan as ``df.explain`` prints it (final plan once executed)."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
