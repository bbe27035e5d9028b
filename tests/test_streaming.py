import json
import os
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tapeflow import constants as C
from tapeflow.operators import blocks
from tapeflow.operators import price_state as PS
from tapeflow.operators import windows as W
from tapeflow.operators.ingest import split_rejects, unwrap_messages, validate_trades
from tapeflow.plans.pipelines import ingest_messages, mark_trades
from tapeflow.operators.regression import predict_prices
from tapeflow.operators.stats import every_snapshot, running_totals, stats_at
from tapeflow.session import durable, durable_dir
from tapeflow.settings import Settings
from tapeflow.sources.synthetic import BASE_PRICES, synth_window_tables
from tapeflow.sources.tables import read_window_table
from tapeflow.sources import topics
from tapeflow.sources.topics import read_trade_messages, read_trade_stream, with_short_arrival
from tapeflow.schemas import SLIDING_TABLE
from tapeflow.streaming.state import mark_batch, no_memory
from tapeflow.streaming import jobs
from tapeflow.streaming.backfill import close_windows, open_windows, whole_table

NOON = 1704110400000
NOW = {"availableNow": True}


class Feed:
    """A directory that files of JSON lines arrive in, one micro-batch each."""

    def __init__(self, path):
        self.path, self.files = path, 0
        path.mkdir()

    def add(self, *records):
        name = self.path / f"{self.files:04d}.json"
        name.write_text("\n".join(json.dumps(r) for r in records) + "\n")
        os.utime(name, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1


def record(symbol, price, ts, trade_id, **more):
    return {"symbol": symbol, "price": price, "quantity": 1.0, "trade_value_usdt": price,
            "timestamp_ms": ts, "trade_id": trade_id, "is_price_spike": False} | more


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "feed")


@pytest.fixture
def settings(tmp_path):
    return Settings(sink="parquet", output_dir=str(tmp_path / "out"), checkpoint_dir=str(tmp_path / "cp"))


def run(spark, settings, feed, **options):
    started = jobs.start_pipeline(
        spark, settings, json_dir=str(feed.path), max_per_trigger=1, trigger=NOW, **options
    )
    for query in started:
        query.awaitTermination()
    return started


def table(spark, settings, name):
    schema = {} if name == C.TUMBLING_NAME else {"schema": SLIDING_TABLE}
    return read_window_table(spark, settings.output_path(name), use_log=True, **schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_over_closed_windows(spark, feed, settings):
    draw = random.Random(4)
    ts = NOON
    for batch in range(5):
        lines = []
        for k in range(40):
            ts += draw.randrange(8_000)
            lines.append(record(draw.choice(["a", "B"]), draw.randrange(1, 50) / 4, ts, draw.randrange(150)))
        lines += [record("A", 0, ts, -1), record("A", "1", ts, -2), record("", 1, ts, -3)]
        feed.add(*lines)
    run(spark, settings, feed)
    batch = W.valid_trades(W.parse_clean_trades(read_trade_messages(spark, json_dir=str(feed.path))))
    # Copies across batches are later in time, so both sides keep the earliest.
    batch = W.clean_trades(batch)
    closed = F.col("window_end") <= F.timestamp_millis(F.lit(ts - 120_000))
    for name, build in ((C.TUMBLING_NAME, W.aggregate_tumbling), (C.SLIDING_NAME, W.aggregate_sliding)):
        expected = rows(build(batch).filter(closed))
        assert expected and rows(table(spark, settings, name)) == expected


def test_late_row_is_dropped_and_counted(spark, feed, settings):
    feed.add(record("A", 1.0, NOON, 1))
    feed.add(record("A", 1.0, NOON + 600_000, 2))
    feed.add(record("A", 1.0, NOON + 601_000, 3))
    feed.add(record("A", 9.0, NOON + 1_000, 4), record("A", 1.0, NOON + 900_000, 5))

    def run_and_count(least):
        late = jobs.LateRows(spark, settings)
        spark.streams.addListener(late)
        run(spark, settings, feed)
        until = time.time() + 20
        while time.time() < until and any(late.total(t) < least for t in (C.TUMBLING_NAME, C.SLIDING_NAME)):
            time.sleep(0.1)
        spark.streams.removeListener(late)
        return [late.total(t) for t in (C.TUMBLING_NAME, C.SLIDING_NAME)]

    assert run_and_count(1) == [1, 1]
    first = table(spark, settings, C.TUMBLING_NAME).first()
    assert (first.trade_count, first.avg_price) == (1, 1.0)
    # Counted on after a restart.
    feed.add(record("A", 1.0, NOON + 1_200_000, 6))
    feed.add(record("A", 9.0, NOON + 2_000, 7), record("A", 9.0, NOON + 3_000, 8), record("A", 1.0, NOON + 1_300_000, 9))
    feed.add(record("A", 9.0, NOON + 4_000, 10))
    assert run_and_count(4) == [4, 4]


def test_restart_keeps_the_seen_ids(spark, feed, settings):
    feed.add(record("A", 1.0, NOON, 1), record("A", 2.0, NOON + 1_000, 2))
    run(spark, settings, feed)
    feed.add(record("A", 7.0, NOON + 2_000, 1), record("A", 3.0, NOON + 3_000, 3))
    feed.add(record("A", 1.0, NOON + 900_000, 4))
    run(spark, settings, feed)
    first = table(spark, settings, C.TUMBLING_NAME).first()
    assert (first.trade_count, first.avg_price) == (3, 2.0)


def test_dedup_within_watermark_forgets(spark, feed, settings):
    feed.add(record("A", 1.0, NOON, 1))
    feed.add(record("A", 1.0, NOON + 3_600_000, 2))
    feed.add(record("A", 1.0, NOON + 3_601_000, 3))
    feed.add(record("A", 1.0, NOON + 3_602_000, 1))
    feed.add(record("A", 1.0, NOON + 7_200_000, 5))
    run(spark, settings, feed, dedup="within_watermark")
    counts = [r.trade_count for r in table(spark, settings, C.TUMBLING_NAME).collect()]
    assert counts == [1, 3]


def test_one_file_per_live_batch(spark, feed, settings):
    for minute in range(8):
        feed.add(*[record(s, 1.0, NOON + minute * 60_000, minute * 10 + k) for k, s in enumerate("ABCD")])
    run(spark, settings, feed, files_per_batch=1)
    log = os.path.join(settings.output_path(C.TUMBLING_NAME), "_spark_metadata")
    per_batch = [
        len(open(os.path.join(log, name)).read().splitlines()) - 1
        for name in os.listdir(log) if name.isdigit()
    ]
    assert per_batch and max(per_batch) == 1


def test_a_date_is_written_by_several_tasks(spark, feed, settings):
    feed.add(*[record(s, 1.0, NOON + minute * 60_000, minute * 10 + k) for minute in range(30) for k, s in enumerate("ABCD")])
    run(spark, settings, feed)
    files = [f for f in os.listdir(settings.output_path(C.TUMBLING_NAME)) if f.endswith(".parquet")]
    assert 1 < len(files) <= 4
    assert table(spark, settings, C.TUMBLING_NAME).count() == 4 * 27


def test_open_windows_give_way_to_finished_ones(spark, feed, settings):
    feed.add(record("A", 1.0, NOON, 1), record("A", 3.0, NOON + 180_000, 2))
    run(spark, settings, feed)
    close_windows(spark, settings, C.TUMBLING_NAME)
    feed.add(record("A", 5.0, NOON + 181_000, 3), record("A", 1.0, NOON + 900_000, 4))
    run(spark, settings, feed)
    whole = whole_table(spark, settings, C.TUMBLING_NAME).orderBy("window_start").collect()
    assert [(r.trade_count, r.avg_price) for r in whole] == [(1, 1.0), (2, 4.0)]
    close_windows(spark, settings, C.TUMBLING_NAME)
    assert whole_table(spark, settings, C.TUMBLING_NAME).count() == 3
    assert open_windows(spark, settings, C.SLIDING_NAME).columns == SLIDING_TABLE.names


def test_updates_hold_the_newest_values(spark, feed, tmp_path):
    feed.add(record("A", 1.0, NOON, 1))
    feed.add(record("A", 3.0, NOON + 1_000, 2), record("B", 7.0, NOON, 1))
    updates = Settings(sink="updates", output_dir=str(tmp_path / "out"), checkpoint_dir=str(tmp_path / "cp"))
    run(spark, updates, feed)
    newest = jobs.latest_updates(spark, updates, C.TUMBLING_NAME)
    assert rows(newest.select("symbol", "trade_count", "avg_price")) == [("A", 2, 2.0), ("B", 1, 7.0)]


def test_partitioned_table(spark, feed, settings):
    feed.add(record("A", 1.0, NOON, 1))
    feed.add(record("A", 1.0, NOON + 86_400_000, 2))
    run(spark, settings, feed, partition_by="event_date")
    assert os.path.isdir(settings.output_path(C.TUMBLING_NAME) + "/event_date=2024-01-01")
    assert table(spark, settings, C.TUMBLING_NAME).count() == 1


def test_console_and_unknown_sinks(spark, feed, settings, tmp_path):
    feed.add(record("A", 1.0, NOON, 1))
    console = Settings(sink="console", checkpoint_dir=str(tmp_path / "console"))
    started = run(spark, console, feed)
    assert [q.name for q in started] == ["tumbling_1m_console", "sliding_5m_1m_console"]
    with pytest.raises(ValueError):
        run(spark, Settings(sink="paper", checkpoint_dir=str(tmp_path / "paper")), feed)


def raw(symbol, price, ts, trade_id, maker=True):
    return {"data": {"e": "trade", "s": symbol, "p": str(price), "q": "1", "T": ts, "m": maker, "t": trade_id}}


@pytest.mark.parametrize("horizon", [3, 2000])
def test_keyed_state_equals_the_batch_form(spark, feed, settings, horizon):
    draw = random.Random(horizon)
    messages, ts = [], NOON
    for _ in range(6):
        batch = []
        for _ in range(30):
            ts += draw.randrange(1, 1000)
            batch.append(raw(draw.choice("AB"), draw.uniform(98, 102), ts, draw.randrange(25)))
        batch.append(raw("A", 0, ts, 1))
        draw.shuffle(batch)
        feed.add(*batch)
        messages += batch
    stream = read_trade_stream(spark, json_dir=str(feed.path), max_per_trigger=1)

    def start():
        jobs.start_ingest(stream, settings, horizon=horizon, interval=2, trigger=NOW).awaitTermination()
        records = spark.read.parquet(settings.output_path(C.CLEAN_TOPIC))
        return W.parse_clean_trades(records, "value")

    clean = start()
    columns = ["symbol", "timestamp_ms", "trade_id", "price", "is_price_spike"]
    table = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")
    accepted, _ = split_rejects(validate_trades(unwrap_messages(table)))
    expected = durable(mark_trades(accepted.drop("value", "raw", "parse_ok"), horizon))
    kept = expected.filter("not is_duplicate").select(columns)
    assert rows(clean.select(columns)) == rows(kept)
    rejects = spark.read.parquet(settings.output_path("rejects"))
    duplicates = expected.filter("is_duplicate").count()
    counts = {r.reject_reason: r.n for r in rejects.groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
    assert counts == {"non_positive": 6, "duplicate": duplicates}
    observed = spark.read.parquet(settings.output_path("reject_counts")).groupBy("reject_reason").agg(F.sum("rejected").alias("n"))
    assert {r.reject_reason: r.n for r in observed.collect()} == counts

    # Statistics count over all micro-batches, as over one table.
    def shown(intervals):
        moments = every_snapshot(intervals, 2)
        return [
            (r.after_trades, r.symbol, r.trades, r.duplicates, r.spikes, r.min_price, r.max_price, pytest.approx(r.total_value))
            for r in moments.orderBy("after_trades", "symbol").collect()
        ]

    whole = running_totals(expected, 2).intervals
    stored = spark.read.parquet(settings.output_path("stats_intervals")).drop("batch")
    assert shown(stored) == shown(whole) and stored.count() < len(shown(whole))
    assert rows(stats_at(stored, 42).select("symbol", "trades")) == rows(stats_at(whole, 42).select("symbol", "trades"))
    carried = os.listdir(settings.checkpoint_path(C.CLEAN_TOPIC) + "/carried/memory")
    assert sorted(carried) == ["batch=4", "batch=5"]

    # The memory outlives a restart.
    last = expected.filter("symbol = 'A' and not is_duplicate").orderBy(F.desc("timestamp_ms")).first()
    feed.add(raw("A", last.price * 2, ts + 1, last.trade_id), raw("A", last.price * 1.03, ts + 2, 999))
    again = start().filter(F.col("timestamp_ms") > ts).collect()
    assert [(r.trade_id, r.is_price_spike) for r in again] == [(999, True)]


def test_ingest_follows_the_order_of_arrival(spark, feed, settings):
    # Times run backwards inside a file; the third line repeats an id, and the fourth is measured against the second.
    feed.add(raw("A", 100, NOON + 9, 1), raw("A", 110, NOON + 8, 2), raw("A", 50, NOON + 7, 1), raw("A", 111, NOON + 6, 3))
    feed.add(raw("A", 50, NOON + 5, 2), raw("A", 120, NOON + 4, 4))
    stream = read_trade_stream(spark, json_dir=str(feed.path), max_per_trigger=1, arrival=True)
    jobs.start_ingest(stream, settings, trigger=NOW).awaitTermination()
    clean = W.parse_clean_trades(spark.read.parquet(settings.output_path(C.CLEAN_TOPIC)), "value")
    expected = [(1, 100.0, False), (2, 110.0, True), (3, 111.0, False), (4, 120.0, True)]
    assert rows(clean.select("trade_id", "price", "is_price_spike")) == expected
    table = durable(read_trade_messages(spark, json_dir=str(feed.path), arrival=True))
    batch = ingest_messages(table, value="json_str", order_by=["arrival"]).clean
    assert rows(batch.select("trade_id", "price", "is_price_spike")) == expected


def test_a_batch_that_is_run_again_counts_once(spark, feed, settings):
    feed.add(raw("A", 100, NOON, 1), raw("A", 110, NOON + 1, 2))
    stream = read_trade_stream(spark, json_dir=str(feed.path), max_per_trigger=1)
    jobs.start_ingest(stream, settings, interval=1, trigger=NOW).awaitTermination()
    feed.add(raw("A", 120, NOON + 2, 3), raw("A", 120, NOON + 3, 1))
    jobs.start_ingest(stream, settings, interval=1, trigger=NOW).awaitTermination()
    # As after a failure behind the writes of the second batch: it was not committed.
    for name in ("1", ".1.crc"):
        os.remove(settings.checkpoint_path(C.CLEAN_TOPIC) + f"/commits/{name}")
    jobs.start_ingest(stream, settings, interval=1, trigger=NOW).awaitTermination()
    stats = spark.read.parquet(settings.output_path("symbol_stats")).filter("batch = 1").collect()
    assert [(r.trades, r.duplicates, r.spikes) for r in stats] == [(3, 1, 2)]
    assert spark.read.parquet(settings.output_path(C.CLEAN_TOPIC)).count() == 3


def test_layers_and_statistics(spark, feed, settings):
    feed.add(raw("btc", 100, NOON, 1), raw("btc", 110, NOON + 1, 2), raw("btc", 110, NOON + 2, 2))
    feed.add({}, raw("eth", -1, NOON, 1), raw("eth", 5, NOON, 1))
    (feed.path / "9999.json").write_text("not json\n")
    stream = read_trade_stream(spark, json_dir=str(feed.path), max_per_trigger=1)
    for query in (jobs.write_raw(stream, settings, trigger=NOW), jobs.start_ingest(stream, settings, trigger=NOW)):
        query.awaitTermination()
    layer = spark.read.parquet(settings.output_path(C.RAW_TOPIC))
    assert layer.count() == 7 and layer.filter("not parse_ok").count() == 1
    clean = W.parse_clean_trades(spark.read.parquet(settings.output_path(C.CLEAN_TOPIC)), "value")
    assert sorted((r.symbol, r.trade_id, r.is_price_spike) for r in clean.collect()) == [
        ("BTC", 1, False), ("BTC", 2, True), ("ETH", 1, False)
    ]
    stats = spark.read.parquet(settings.output_path("symbol_stats"))
    last = stats.filter(F.col("batch") == stats.agg(F.max("batch")).first()[0])
    assert sorted((r.symbol, r.trades, r.duplicates, r.spikes) for r in last.collect()) == [
        ("BTC", 2, 1, 1), ("ETH", 1, 0, 0)
    ]
    table = read_trade_messages(spark, json_dir=str(feed.path))
    batch = ingest_messages(table, value="json_str").clean
    assert rows(batch.select("symbol", "trade_id")) == rows(clean.select("symbol", "trade_id"))


def test_scores_are_refreshed(spark, settings):
    stored = os.path.join(durable_dir(spark).removeprefix("file:"), "tapeflow")
    before = set(os.listdir(stored)) if os.path.isdir(stored) else set()
    tumbling, _ = synth_window_tables(spark, datetime(2024, 1, 1))
    path = settings.output_path(C.TUMBLING_NAME)
    tumbling.filter("minute(window_start) < 40").write.mode("append").parquet(path)
    jobs.refresh_scores(spark, settings, trigger=NOW).awaitTermination()
    tumbling.filter("minute(window_start) >= 40").write.mode("append").parquet(path)
    jobs.refresh_scores(spark, settings, trigger=NOW).awaitTermination()
    scores = jobs.latest_scores(spark, settings)
    # Every symbol is scored, and the refresh before is still there for its readers.
    assert scores.count() == 180 and {r.symbol for r in scores.collect()} == set(BASE_PRICES)
    assert sorted(os.listdir(settings.output_path("scores"))) == ["refresh=0", "refresh=1"]
    assert {"anomaly", "anomaly_score", "predicted_price", "pred_error"} <= set(scores.columns)
    # Intermediate tables of a refresh are gone.
    assert set(os.listdir(stored)) == before


def test_price_models_are_merged(spark, settings):
    tumbling, _ = synth_window_tables(spark, datetime(2024, 1, 1))
    tumbling = durable(tumbling)
    path, minute = settings.output_path(C.TUMBLING_NAME), F.minute("window_start")

    def refresh(rows):
        rows.write.mode("append").parquet(path)
        jobs.refresh_prices(spark, settings, trigger=NOW).awaitTermination()

    def models():
        folder = settings.checkpoint_path("prices") + "/state"
        newest = max(os.listdir(folder))
        state = PS.PriceState(*[spark.read.parquet(f"{folder}/{newest}/{part}") for part in ("moments", "tail")])
        return {r.symbol: (r.intercept, list(r.weights)) for r in PS.price_models(state).collect()}

    def whole(rows):
        state = PS.merge_windows(PS.no_prices(spark), rows)
        return {r.symbol: (pytest.approx(r.intercept), pytest.approx(list(r.weights))) for r in PS.price_models(state).collect()}

    refresh(tumbling.filter(minute < 20))
    refresh(tumbling.filter((minute >= 20) & (minute < 21) & (F.col("symbol") != "BTCUSDT")))
    refresh(tumbling.filter((minute >= 21) & (minute < 50)))
    seen = (minute < 50) & ((minute != 20) | (F.col("symbol") != "BTCUSDT"))
    assert models() == whole(tumbling.filter(seen)) and len(models()) == 3
    got = {(r.symbol, r.window_start): r.predicted_price for r in spark.read.parquet(settings.output_path("prices")).filter("refresh = 2").collect()}
    full = {(r.symbol, r.window_start): r.predicted_price for r in predict_prices(tumbling.filter(seen)).filter(minute >= 21).collect()}
    assert got.keys() == full.keys() and all(got[k] == pytest.approx(full[k], rel=1e-7) for k in full)
    # A window behind later ones: all is fitted again.
    refresh(tumbling.filter((minute == 20) & (F.col("symbol") == "BTCUSDT")))
    assert models() == whole(tumbling.filter(minute < 50))


def test_a_micro_batch_is_sorted_once_for_ids_prices_and_memory(spark, trades, monkeypatch):
    draw = random.Random(3)
    rows = [(draw.choice("AAB"), draw.uniform(98, 103), n, draw.randrange(60)) for n in range(200)]
    sorts, sort = [], blocks.range_parts
    monkeypatch.setattr(blocks, "range_parts", lambda *a, **k: sorts.append(a) or sort(*a, **k))
    valid = durable(trades(*rows).select("symbol", "price", "quantity", "timestamp_ms", "trade_id"))
    marked, memory = mark_batch(valid, no_memory(spark), 20)
    got = {r.timestamp_ms: (r.is_duplicate, r.is_price_spike) for r in marked.collect()}
    assert len(sorts) == 1
    ids, last, expected = {}, {}, {}
    for symbol, price, at, trade_id in rows:
        mine = ids.setdefault(symbol, [])
        copy = trade_id in mine[-20:]
        spike = not copy and symbol in last and abs(price - last[symbol]) / last[symbol] * 100 > 2
        expected[at] = (copy, spike)
        if not copy:
            mine.append(trade_id)
            last[symbol] = price
    assert got == expected
    kept = sorted((r.symbol, r._seq, r.trade_id) for r in memory.collect())
    assert kept == sorted((s, -n, i) for s, mine in ids.items() for n, i in enumerate(mine[::-1][:20], 1))


def test_short_arrival_keeps_the_order(spark, tmp_path):
    for name in ("b", "a", "c"):
        (tmp_path / name).write_text("".join(f"{name}{n}\n" for n in range(5)))
    table = durable(read_trade_messages(spark, json_dir=str(tmp_path), arrival=True))
    short = with_short_arrival(table)
    assert [f.name for f in short.schema["arrival"].dataType] == ["block", "row"]
    texts = [[r.json_str for r in t.orderBy("arrival").collect()] for t in (table, short)]
    assert texts[0] == texts[1] == [f"{c}{n}" for c in "abc" for n in range(5)]


def test_short_arrival_follows_the_offsets_of_a_topic(spark, monkeypatch):
    monkeypatch.setattr(topics, "BLOCK_ROWS", 4)
    # Two tasks read partition 0, the later one its first offsets; offsets have gaps.
    places = [(0, 100 + 3 * n, n) for n in range(10)] + [(0, 2 * n, (1 << 33) + n) for n in range(9)] + [(1, n, (2 << 33) + n) for n in range(5)]
    table = spark.createDataFrame([(p,) for p in places], "arrival struct<partition: int, offset: bigint, row: bigint>")
    short = with_short_arrival(durable(table.withColumn("place", F.col("arrival"))))
    assert [tuple(r.place) for r in short.orderBy("arrival").collect()] == sorted(places)
    assert short.select("arrival.block").distinct().count() == 3 + 3 + 2


@pytest.mark.parametrize("horizon", [2, 9])
def test_messages_in_order_of_arrival_are_not_sorted(spark, feed, settings, monkeypatch, horizon):
    sorts, sort = [], blocks.range_parts
    monkeypatch.setattr(blocks, "range_parts", lambda *a, **k: sorts.append(a) or sort(*a, **k))
    monkeypatch.setattr(topics, "BLOCK_ROWS", 8)
    draw = random.Random(horizon)
    ids, last, totals, clean, copies, snapshots, n = {}, {}, {}, [], [], [], 0
    for _ in range(6):
        lines = []
        for _ in range(40):
            symbol, price, trade_id = draw.choice("AAAB") if n % 50 < 35 else "C", draw.uniform(98, 102), draw.randrange(12)
            lines.append(raw(symbol, price, NOON + draw.randrange(10**6), trade_id))
            mine, seen = ids.setdefault(symbol, []), totals.setdefault(symbol, [0, 0, 0])
            if trade_id in mine[-horizon:]:
                seen[1] += 1
                copies.append((symbol, trade_id, json.dumps(lines[-1])))
            else:
                spike = symbol in last and abs(price - last[symbol]) / last[symbol] * 100 > 2
                clean.append((symbol, trade_id, price, spike))
                mine.append(trade_id)
                last[symbol] = price
                seen[0], seen[2], n = seen[0] + 1, seen[2] + spike, n + 1
                if n % 5 == 0:
                    snapshots += [(n, s, *t) for s, t in totals.items()]
            if draw.random() < 0.2:
                lines.append(raw(symbol, 0, NOON, trade_id))
        feed.add(*lines)
    stream = read_trade_stream(spark, json_dir=str(feed.path), max_per_trigger=2, arrival=True)
    jobs.start_ingest(stream, settings, horizon=horizon, interval=5, trigger=NOW).awaitTermination()
    assert not sorts
    records = W.parse_clean_trades(spark.read.parquet(settings.output_path(C.CLEAN_TOPIC)), "value")
    assert rows(records.select("symbol", "trade_id", "price", "is_price_spike")) == sorted(clean)
    rejects = spark.read.parquet(settings.output_path("rejects")).filter("reject_reason = 'duplicate'")
    assert rows(rejects.select("symbol", "trade_id", "json_str")) == sorted(copies)
    intervals = spark.read.parquet(settings.output_path("stats_intervals")).drop("batch")
    moments = every_snapshot(intervals, 5).filter("trades + duplicates > 0")
    assert rows(moments.select("after_trades", "symbol", "trades", "duplicates", "spikes")) == sorted(snapshots)
