import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from tapeflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def trades(spark):
    """Clean-trade tables from tuples (symbol, price, timestamp_ms, trade_id[, quantity])."""

    def make(*rows):
        from pyspark.sql import functions as F

        schema = "symbol string, price double, timestamp_ms bigint, trade_id bigint, quantity double"
        table = spark.createDataFrame([(*r, 1.0)[:5] for r in rows], schema)
        return table.withColumns(
            {
                "trade_value_usdt": F.round(F.col("price") * F.col("quantity"), 6),
                "event_time": F.timestamp_millis("timestamp_ms"),
                "is_price_spike": F.lit(False),
            }
        )

    return make
