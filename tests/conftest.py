import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# tasks import the package too, whatever folder the tests are started from
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cairn.session import build_session

    scratch = tempfile.mkdtemp(prefix="cairn-test-")
    session = build_session(
        master="local[*]",
        app="cairn-tests",
        extra={"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": f"{scratch}/ckpt"},
    )
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from cairn.session import shared_dir

    return tempfile.mkdtemp(prefix="t-", dir=shared_dir(spark))


@pytest.fixture(scope="session")
def duck_small():
    from compare import duck

    return duck(SF_SMALL)


def raw_rows(spark, rows, landed=False):
    """Hand-written raw activity records; unspecified fields are NULL."""
    from cairn.schemas import RAW_ACTIVITY, RAW_ACTIVITY_LANDED

    schema = RAW_ACTIVITY_LANDED if landed else RAW_ACTIVITY
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)
