import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from scriptorium.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate a column function on single values: value(function, *arguments)."""
    from pyspark.sql import functions as F

    def evaluate(function, *arguments):
        schema = ", ".join(f"c{i} string" for i in range(len(arguments)))
        row = spark.createDataFrame([tuple(arguments)], schema)
        return row.select(function(*[F.col(f"c{i}") for i in range(len(arguments))])
                          .alias("v")).first()["v"]
    return evaluate


@pytest.fixture(scope="session")
def sf_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.is_dir():
        pytest.skip("no test tables")
    return str(path)
