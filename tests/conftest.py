import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
# Workers import the plug-ins that the test modules define.
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).parent), os.environ.get("PYTHONPATH", "")])

from quire.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("quire-tests", cores=8, **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
