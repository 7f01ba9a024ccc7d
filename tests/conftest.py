import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from quarry.session import session

    s = session("local[4]", "quarry-tests", **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    return s
