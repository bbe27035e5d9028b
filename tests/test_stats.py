import random

import pytest
from pyspark.sql import functions as F

from tapeflow.operators import blocks as B
from tapeflow.operators import stats as S
from tapeflow.plans.pipelines import mark_trades
from tapeflow.session import durable


def simulate(rows, interval):
    """Snapshots by a loop over the rows in arrival order."""
    seen, last, stats, accepted = {}, {}, {}, 0
    for symbol, price, ts, trade_id in sorted(rows, key=lambda r: (r[2], r[3])):
        own = stats.setdefault(symbol, {"prices": [], "duplicates": 0, "spikes": 0})
        if trade_id in seen.setdefault(symbol, set()):
            own["duplicates"] += 1
            continue
        seen[symbol].add(trade_id)
        if symbol in last and abs(price - last[symbol]) / last[symbol] * 100 > 2:
            own["spikes"] += 1
        last[symbol] = price
        own["prices"].append(price)
        accepted += 1
        if accepted % interval == 0:
            for name, s in stats.items():
                p = s["prices"]
                yield (accepted, name, len(p), round(sum(p), 6), min(p, default=None),
                       max(p, default=None), s["duplicates"], s["spikes"])


@pytest.mark.parametrize("span", [1, 3, 10_000])
@pytest.mark.parametrize("interval", [1, 7, 50])
def test_snapshots(trades, interval, span):
    draw = random.Random(interval)
    rows = [("A", 1.0, 1, 0), ("A", 2.0, 2, 0)]
    rows += [
        ("R" if ts in (40, 170) else draw.choice("AAAB"), draw.uniform(99, 103), ts, draw.randrange(120))
        for ts in range(3, 200)
    ]
    got = S.stats_snapshots(mark_trades(trades(*rows)), interval, span=span).collect()
    mine = {
        (r.after_trades, r.symbol): (
            r.trades, pytest.approx(r.avg_price * r.trades, abs=1e-5), r.min_price, r.max_price,
            r.duplicates, r.spikes,
        )
        for r in got
    }
    expected = {(n, s): tuple(rest) for n, s, *rest in simulate(rows, interval)}
    assert len(got) == len(expected) and mine == expected


def test_one_sort_serves_spikes_and_totals(trades, monkeypatch):
    draw = random.Random(5)
    rows = [
        (draw.choice(["A", "A", "B", None]), draw.choice([draw.uniform(99, 103)] * 9 + [None]), draw.randrange(90), draw.randrange(150))
        for _ in range(400)
    ]
    table = durable(trades(*rows).select("symbol", "price", "quantity", "timestamp_ms", "trade_id"))
    apart = S.running_totals(durable(mark_trades(table)), 7)
    sorts, sort = [], B.range_parts
    monkeypatch.setattr(B, "range_parts", lambda *a, **k: sorts.append(a) or sort(*a, **k))
    once = S.running_totals(durable(mark_trades(table, placed=True)), 7)
    assert len(sorts) == 1
    shown = [c for c in once.intervals.columns if c not in ("avg_price", "total_value")]
    for a, b in ((apart.intervals, once.intervals), (apart.carried, once.carried)):
        names = [c for c in shown if c in a.columns]
        assert sorted(map(repr, a.select(*names).collect())) == sorted(map(repr, b.select(*names).collect()))


def test_too_few_trades_give_no_snapshot(trades):
    assert S.stats_snapshots(mark_trades(trades(("A", 1.0, 1, 1)))).count() == 0


def test_symbol_stats(trades):
    clean = trades(("A", 1.0, 1, 1), ("A", 3.0, 2, 2)).withColumn("is_price_spike", F.col("price") > 2)
    rejects = clean.sparkSession.createDataFrame(
        [("A", "duplicate"), ("A", "non_positive"), ("B", "duplicate"), (None, "bad_json")],
        "symbol string, reject_reason string",
    )
    a, b = S.symbol_stats(clean, rejects).orderBy("symbol").collect()
    assert (a.trades, a.avg_price, a.min_price, a.max_price, a.total_value) == (2, 2.0, 1.0, 3.0, 4.0)
    assert (a.spikes, a.duplicates, a.dropped) == (1, 1, 1)
    assert (b.trades, b.avg_price, b.duplicates) == (0, 0.0, 1)
