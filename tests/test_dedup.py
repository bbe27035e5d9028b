import random
from collections import deque

import pytest

from tapeflow.operators import dedup as D
from tapeflow.session import durable


def brute_force(rows, horizon):
    """(row, is_duplicate) in arrival order, one memory per symbol."""
    memory = {}
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        seen = memory.setdefault(row[0], deque(maxlen=horizon))
        duplicate = row[3] in seen
        if not duplicate:
            seen.append(row[3])
        yield row, duplicate


def marked(table, **options):
    rows = D.mark_duplicates(table, **options).collect()
    return {(r.symbol, r.timestamp_ms, r.trade_id): r.is_duplicate for r in rows}


def random_rows(count, ids, seed, hot="A"):
    draw = random.Random(seed)
    return [
        (hot if draw.random() < 0.7 else draw.choice("BC"), 1.0, ts, draw.randrange(ids))
        for ts in range(1, count + 1)
    ]


@pytest.mark.parametrize(("horizon", "ids"), [(1, 5), (3, 30), (20, 30), (20, 400), (1000, 400)])
def test_bounded_memory_against_brute_force(trades, horizon, ids):
    rows = random_rows(600, ids, seed=horizon * ids)
    expected = {(r[0], r[2], r[3]): duplicate for r, duplicate in brute_force(rows, horizon)}
    assert marked(trades(*rows), horizon=horizon) == expected


def test_blocks_that_depend_on_all_earlier_blocks(trades):
    # Two ids in turn with a memory of one: every acceptance depends on the one before.
    rows = [("A", 1.0, ts, (ts // 3) % 2) for ts in range(1, 200)]
    expected = {(r[0], r[2], r[3]): duplicate for r, duplicate in brute_force(rows, 1)}
    assert marked(trades(*rows), horizon=1) == expected


def test_an_id_with_more_copies_than_a_span(trades, monkeypatch):
    monkeypatch.setattr(D, "_COPIES", 8)
    rows = [("A", 1.0, ts, 0 if ts % 3 == 0 else ts) for ts in range(1, 900)]
    for horizon in (1, 2, 5, 40):
        expected = {(r[0], r[2], r[3]): duplicate for r, duplicate in brute_force(rows, horizon)}
        assert marked(trades(*rows), horizon=horizon) == expected


def test_copies_that_tie_in_all_columns(trades):
    rows = [("A", 1.0, 5, 7)] * 4 + [("A", 1.0, 6, 8)]
    flags = [r.is_duplicate for r in D.mark_duplicates(trades(*rows), horizon=3).collect()]
    assert sorted(flags) == [False, False, True, True, True]


def test_id_returns_after_the_horizon(trades):
    rows = [("A", 1.0, ts, ts) for ts in range(1, 2003)] + [("A", 1.0, 9000, 1), ("A", 1.0, 9001, 2002)]
    flags = marked(trades(*rows), horizon=2000)
    assert not flags["A", 9000, 1] and flags["A", 9001, 2002]


def test_unbounded_memory(trades):
    rows = random_rows(500, 40, seed=5)
    expected = {(r[0], r[2], r[3]): d for r, d in brute_force(rows, None)}
    table = trades(*rows).repartition(3)
    assert marked(table) == expected
    kept = D.dedup_recent(table)
    assert kept.count() == sum(not d for d in expected.values())
    assert D.dedup_recent(kept).count() == kept.count()


def test_same_id_of_another_symbol_is_kept(trades):
    assert D.dedup_recent(trades(("A", 1.0, 1, 1), ("B", 1.0, 2, 1), ("A", 1.0, 3, 1))).count() == 2


def test_copies_are_reduced_before_the_shuffle(trades):
    table = D.dedup_recent(trades(*[("A", 1.0, ts, 1) for ts in range(1, 50)]))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_window_rows(spark):
    schema = "symbol string, window_start timestamp, window_end timestamp, trade_count bigint, avg_price double"
    table = spark.sql(
        """SELECT * FROM VALUES
        ('A', timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:01:00', 3L, 1.0D),
        ('A', timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:01:00', 5L, 2.0D),
        ('A', timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:05:00', 5L, 3.0D),
        ('B', timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:01:00', 1L, 4.0D)
        AS t(symbol, window_start, window_end, trade_count, avg_price)"""
    ).to(spark.createDataFrame([], schema).schema)
    assert sorted(r.avg_price for r in D.dedup_windows(table).collect()) == [3.0, 4.0]


def test_ids_are_marked_in_one_shuffle_unless_hot(trades, monkeypatch):
    rows = [("A", 1.0, n, 7) for n in range(300)] + [("B", 1.0, n, n % 40) for n in range(100)]
    table = durable(trades(*rows))
    marked = D.mark_duplicates(table)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
    expected = sorted((r.symbol, r.timestamp_ms, r.is_duplicate) for r in marked.collect())
    assert expected == sorted([("A", n, n > 0) for n in range(300)] + [("B", n, n >= 40) for n in range(100)])
    monkeypatch.setattr(D, "_COPIES", 10)  # ids in buckets of more than 80 rows are hot
    assert D._hot_buckets(table)
    hot = D.mark_duplicates(table)
    assert expected == sorted((r.symbol, r.timestamp_ms, r.is_duplicate) for r in hot.collect())
