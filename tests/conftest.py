import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tenura.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        4, partitions=4, **{"spark.driver.memory": "4g", "spark.checkpoint.dir": shared,
                            "spark.sql.warehouse.dir": f"{shared}/warehouse"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test tables are not here")
    return path


@pytest.fixture(scope="session")
def raw(spark, sf_dir):
    from checks.common import raw as people

    return people(spark, sf_dir).cache()


@pytest.fixture(scope="session")
def clean(raw):
    from tenura.plans import silver

    return silver.clean(raw).cache()
