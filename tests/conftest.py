import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from parley.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(warehouse),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EVENTS = [
    # (userid, message, minute, campaign): the shape of a small sample day
    ("u1", "first look at the blue bottle", 0, "c1"),
    ("u2", "nice bottle, good price", 1, "c1"),
    ("u3", "not for me", 2, "c2"),
    ("u1", "bought the blue bottle twice", 10, "c1"),
    ("u2", "any news on the night lamp?", 15, "c3"),
    ("u4", "the lamp is too bright", 20, "c4"),
    ("u3", "prefer the wooden one", 25, "c2"),
    ("u5", "works outside as well", 30, "c5"),
]


@pytest.fixture(scope="session")
def sample(spark):
    rows = [(u, m, f"2026-01-10T10:{t:02d}:00Z", c) for u, m, t, c in EVENTS]
    from parley.sources.events import parse_time
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "userid string, message string, timestamp string, campaign string")
    return df.withColumn("timestamp", parse_time(F.col("timestamp")))
