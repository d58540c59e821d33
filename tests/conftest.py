import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from jobtide.session import local_session

    session = local_session(8, app="tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a function of one text column over a list of texts."""
    from pyspark.sql import functions as F

    def run(values, function, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i INT, v {kind}")
        return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]

    return run
