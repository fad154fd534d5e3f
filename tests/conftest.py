import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from padron.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Applies a Column rule to a list of values and returns the results in order."""
    from pyspark.sql import functions as F

    def apply(rule, values, type="string"):
        rows = list(enumerate(values))
        frame = spark.createDataFrame(rows, f"i int, v {type}").select("i", rule(F.col("v")).alias("r"))
        return [r["r"] for r in sorted(frame.collect(), key=lambda r: r["i"])]

    return apply


@pytest.fixture
def grid_of(spark):
    """A grid from {(file, sheet): {row_idx: cells}}."""

    def make(sheets):
        rows = [(f, s, i, c) for (f, s), lines in sheets.items() for i, c in lines.items()]
        return spark.createDataFrame(rows, "file string, sheet string, row_idx bigint, cells array<string>")

    return make
