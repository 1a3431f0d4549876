import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from palmleaf.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", f"local[{os.environ.get('BENCH_CPUS', '4')}]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
