import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemart import session

    spark = session.build(
        "local[8]", "tests", **{"spark.sql.shuffle.partitions": "4",
                                "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
                                "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield spark
    spark.stop()
