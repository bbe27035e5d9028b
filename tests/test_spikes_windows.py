import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapeflow.operators import windows as W
from tapeflow.operators.blocks import BLOCK, HALO, range_parts, with_halo
from tapeflow.operators.spikes import flag_spikes
from tapeflow.plans.pipelines import mark_trades

NOON = 1704110400000  # 2024-01-01 12:00 UTC


@pytest.mark.parametrize("split", [True, False])
def test_threshold_is_strict(trades, split):
    table = trades(("A", 100.0, NOON, 1), ("A", 102.0, NOON + 1, 2), ("A", 104.05, NOON + 2000, 3))
    flags = {r.trade_id: r.is_price_spike for r in flag_spikes(table, split=split).collect()}
    assert flags == {1: False, 2: False, 3: True}


def test_spike_is_measured_against_the_last_accepted_trade(trades):
    table = trades(("A", 100.0, 1, 1), ("A", 200.0, 2, 1), ("A", 101.0, 3, 2))
    flags = {(r.trade_id, r.is_duplicate): r.is_price_spike for r in mark_trades(table).collect()}
    assert flags == {(1, False): False, (1, True): False, (2, False): False}


@pytest.mark.parametrize("parts", ["1", "4", "37", "400"])
def test_parts_equal_the_plain_window(spark, trades, parts):
    draw = random.Random(1)
    rows = [
        ("A" if draw.random() < 0.8 else "B", draw.uniform(98, 102), NOON + draw.randrange(300_000), i)
        for i in range(400)
    ]
    table = trades(*rows)
    plain = {r.trade_id: r.is_price_spike for r in flag_spikes(table, split=False).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    split = {r.trade_id: r.is_price_spike for r in flag_spikes(table).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert split == plain
    assert any(plain.values()) and not all(plain.values())


def test_halo_reaches_over_thin_blocks(trades):
    # One row per block, so nine rows back means nine blocks back.
    table = trades(*[("A", float(i), i, i) for i in range(20)]).select("symbol", "price", "trade_id")
    blocked = table.withColumn(BLOCK, F.col("trade_id"))
    halo = with_halo(blocked, ["symbol"], ["trade_id"], ["price"], before=9, after=2).filter(HALO)
    last = sorted(r.trade_id for r in halo.filter(F.col(BLOCK) == 15).collect())
    assert last == [*range(6, 15), 16, 17]


def test_range_parts_split_a_hot_key(trades):
    rows = [("A", 1.0, NOON, i) for i in range(900)] + [("B", 1.0, NOON, i) for i in range(100)]
    parts = range_parts(trades(*rows), ["symbol", "timestamp_ms", "trade_id"], parts=8)
    sizes = [r["count"] for r in parts.groupBy("_part").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 400


def test_event_time_keeps_milliseconds(spark):
    record = '{"symbol":"btc","timestamp_ms":1740754800999,"price":1,"quantity":1,"trade_id":1}'
    table = spark.createDataFrame([(record,), ("junk",)], "json_str string")
    row = W.parse_clean_trades(table).first()
    assert row.symbol == "BTC"
    assert row.event_time == dt.datetime(2025, 2, 28, 15, 0, 0, 999000)
    assert W.clean_trades(W.parse_clean_trades(table)).count() == 1


def test_validity(trades):
    nan, inf = float("nan"), float("inf")
    rows = [("A", 1.0, 1, 1), ("", 1.0, 1, 2), (None, 1.0, 1, 3), ("A", 0.0, 1, 4), ("A", None, 1, 5)]
    rows += [("A", 1.0, 0, 6), ("A", 1.0, 1, 7, -1.0), ("A", nan, 1, 8), ("A", inf, 1, 9)]
    table = trades(*rows)
    assert [r.trade_id for r in W.clean_trades(table).collect()] == [1]
    loose = W.clean_trades(table, reject_non_finite=False)
    assert sorted(r.trade_id for r in loose.collect()) == [1, 8, 9]


def test_null_ids_of_a_symbol_collapse(trades):
    assert W.clean_trades(trades(("A", 1.0, 1, None), ("A", 2.0, 2, None))).count() == 1


def test_tumbling(trades):
    table = trades(("A", 1.0, NOON, 1, 2.0), ("A", 3.0, NOON + 59_999, 2), ("A", 5.0, NOON + 60_000, 3))
    table = table.withColumns(
        {
            "is_price_spike": F.when(F.col("trade_id") == 1, True),
            "trade_value_usdt": F.when(F.col("trade_id") != 2, F.col("trade_value_usdt")),
        }
    )
    first, second = W.aggregate_tumbling(table).orderBy("window_start").collect()
    assert (first.trade_count, first.avg_price, first.sum_qty, first.spike_count) == (2, 2.0, 3.0, 1)
    assert first.sum_value == 2.0 and str(first.event_date) == "2024-01-01"
    assert (second.trade_count, second.spike_count) == (1, 0)
    assert second.window_start == first.window_end == dt.datetime(2024, 1, 1, 12, 1)


@pytest.mark.parametrize("from_partials", [True, False])
def test_one_trade_lies_in_five_sliding_windows(trades, from_partials):
    rows = W.aggregate_sliding(trades(("A", 1.0, NOON + 270_000, 1)), from_partials=from_partials)
    starts = sorted(r.window_start.minute for r in rows.collect())
    assert starts == [0, 1, 2, 3, 4]


def test_sliding_counts_are_sums_of_tumbling_counts(trades):
    draw = random.Random(2)
    rows = [(draw.choice("AB"), draw.uniform(1, 9), NOON + draw.randrange(1_800_000), i) for i in range(300)]
    table = trades(*rows)
    tumbling = {(r.symbol, r.window_start): r for r in W.aggregate_tumbling(table).collect()}
    assert sum(r.trade_count for r in tumbling.values()) == 300
    for from_partials in (True, False):
        for row in W.aggregate_sliding(table, from_partials=from_partials).collect():
            inside = [
                tumbling[key]
                for k in range(5)
                if (key := (row.symbol, row.window_start + dt.timedelta(minutes=k))) in tumbling
            ]
            assert row.trade_count == sum(r.trade_count for r in inside)
            assert row.sum_value == pytest.approx(sum(r.sum_value for r in inside))


def test_a_slide_that_does_not_divide_the_width(trades):
    table = trades(("A", 1.0, NOON + 1, 1), ("A", 2.0, NOON + 100_000, 2))
    assert W.aggregate_sliding(table, "5 minutes", "2 minutes").count() > 0
    with pytest.raises(ValueError):
        W.aggregate_sliding(table, "5 minutes", "2 minutes", from_partials=True)
