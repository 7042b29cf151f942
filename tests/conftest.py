import os
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# the workers import the package, and the tests' own functions, by name
folders = [HERE.parent, HERE, *(p for p in HERE.iterdir() if p.is_dir())]
os.environ["PYTHONPATH"] = os.pathsep.join([*map(str, folders), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from corpusloom.session import local_session

    return local_session(4, partitions=4, memory="4g", shared=f"file://{tmp_path_factory.mktemp('shared')}")


@pytest.fixture(scope="session")
def small():
    """The driver's smallest tables, where they are there."""
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test tables")
    return str(path)
