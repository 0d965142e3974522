import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from knnrec.session import build_session

    session = build_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield session
    session.stop()


def ratings_df(spark, rows):
    return spark.createDataFrame([(int(u), int(i), float(r)) for u, i, r in rows], "u long, i long, r double")
