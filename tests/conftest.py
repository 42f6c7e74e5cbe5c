import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark import cloudpickle

    import plumbline
    from plumbline.session import local_session

    cloudpickle.register_pickle_by_value(plumbline)
    s = local_session("8", shuffle_partitions=4, app="tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    """frame(rows, ddl): a table spread over several partitions."""

    def make(rows, ddl, parts=3):
        return spark.createDataFrame(rows, ddl).repartition(parts)

    return make
