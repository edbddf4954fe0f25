import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from odometer.session import build_session, shared_dir

    session = build_session(
        "local[4]",
        app_name="odometer-tests",
        shuffle_partitions=4,
        extra_conf={"spark.driver.memory": "4g"},
    )
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="odometer-tests-"))
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from odometer.session import local_path, scratch_path

    path = local_path(scratch_path(spark, "tests"))
    os.makedirs(path, exist_ok=True)
    return path
