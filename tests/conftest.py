import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripflow.session import get_session, scratch_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[2]", app_name="tripflow-tests", shuffle_partitions=4)
    scratch_root(session)  # a private folder only when the setting is absent
    yield session
    session.stop()


SF_SMALL = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
