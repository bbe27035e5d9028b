"""Physical plans of the hot paths."""

import re

import pytest
from pyspark.sql import functions as F

from tapeflow.operators import windows as W
from tapeflow.operators.blocks import range_parts
from tapeflow.operators.dedup import mark_duplicates
from tapeflow.operators.spikes import flag_spikes
from tapeflow.operators.windows import clean_trades
from tapeflow.session import durable
from tapeflow.sources.adapters import as_trades


@pytest.fixture(scope="module")
def stored(spark):
    columns = {
        "symbol": "concat('S', id % 5)",
        "price": "1.0 + id % 7",
        "quantity": "1.0",
        "timestamp_ms": "1704110400000 + id * 1000",
        "is_buyer_maker": "true",
        "trade_id": "id",
    }
    return durable(as_trades(spark.range(1000), **columns))


def plan_of(table):
    return table._jdf.queryExecution().executedPlan().toString()


def test_windows_read_only_their_columns(spark, stored):
    # The plan's text cuts the list of pushed filters short otherwise.
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(W.aggregate_tumbling(clean_trades(stored, dedup=None)))
    scanned = re.search(r"FileScan parquet \[(.*?)\]", plan).group(1)
    names = {column.split("#")[0] for column in scanned.split(",")}
    assert names == {
        "symbol", "price", "quantity", "trade_value_usdt", "timestamp_ms", "is_price_spike", "event_time"
    }
    assert "GreaterThan(price,0.0)" in plan and "GreaterThan(quantity,0.0)" in plan


@pytest.mark.parametrize("build", [W.aggregate_tumbling, W.aggregate_sliding])
def test_windows_are_aggregated_before_the_shuffle(stored, build):
    plan = plan_of(build(clean_trades(stored, dedup=None)))
    first_shuffle = plan.rindex("Exchange")
    assert "partial_count" in plan[first_shuffle:]
    assert "Expand" not in plan[first_shuffle:] and "Generate" not in plan[first_shuffle:]


def test_hot_paths_stay_out_of_python(stored):
    for table in (
        W.aggregate_sliding(clean_trades(stored)),
        flag_spikes(stored),
        flag_spikes(stored, split=False),
    ):
        plan = plan_of(table)
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_spikes_carry_one_row_of_each_part(spark, stored):
    # All trades of one symbol in one millisecond: neither the symbol nor the time can split them.
    columns = {"symbol": F.lit("A"), "timestamp_ms": F.lit(1704110400000).cast("bigint")}
    same = durable(stored.withColumns(columns))
    flagged = flag_spikes(same)
    plan = plan_of(flagged)
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert shuffles and all(keys.startswith("_part") for keys in shuffles)
    assert "Union" not in plan
    parts = range_parts(same, ["symbol", "timestamp_ms", "trade_id"])
    assert max(r["count"] for r in parts.groupBy("_part").count().collect()) < 500


def test_bounded_dedup_stays_out_of_python(stored):
    plan = plan_of(mark_duplicates(stored, horizon=10))
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
