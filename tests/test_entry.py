"""The entry module with and without the optional subpackage."""

import subprocess
import sys

import pytest

from conftest import ROOT

ABSENT = """
import sys
for name in ("cairn.llm", "corpus_pipeline"):
    sys.modules[name] = None  # as if the folders were deleted
import __spark_entry__ as e
names = set(e.queries())
assert names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(e.oracle_sql()) <= names
"""


def test_entry_without_the_optional_subpackage():
    subprocess.run([sys.executable, "-c", ABSENT], cwd=ROOT, check=True, timeout=120)


def test_other_import_errors_are_not_swallowed():
    broken = "import sys; sys.modules['pyarrow'] = None; sys.modules['xxhash'] = None; import __spark_entry__"
    try:
        import cairn.llm.common  # noqa: F401
    except ModuleNotFoundError:
        pytest.skip("the subpackage is absent")
    assert subprocess.run([sys.executable, "-c", broken], cwd=ROOT, capture_output=True, timeout=120).returncode != 0


def test_no_shared_folder_raises(spark, monkeypatch):
    from cairn.session import shared_dir

    class Unset:
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: Unset.conf)})()

    monkeypatch.setenv("CAIRN_SCRATCH", "/tmp")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Unset)
    monkeypatch.delenv("CAIRN_SCRATCH")
    Unset.sparkContext.master = "local[2]"
    with pytest.raises(ValueError):
        shared_dir(Unset)
