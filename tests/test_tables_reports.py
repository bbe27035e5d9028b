import datetime as dt
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeflow import constants as C
from tapeflow.operators import quality, reports
from tapeflow.schemas import CLEAN_TRADE, SLIDING_TABLE, TUMBLING_TABLE
from tapeflow.settings import Settings, load_settings
from tapeflow.sources import synthetic, tables, topics

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def synth(spark):
    return synthetic.synth_window_tables(spark, START)


def test_generated_tables(spark, synth):
    tumbling, sliding = synth
    assert [f.name for f in tumbling.schema] == TUMBLING_TABLE.names
    assert [f.name for f in sliding.schema] == SLIDING_TABLE.names
    frame = tumbling.toPandas()
    assert len(frame) == 180 and set(frame["symbol"]) == set(synthetic.BASE_PRICES)
    for column, (low, high) in (
        ("trade_count", synthetic.TRADE_COUNTS),
        ("sum_qty", synthetic.QUANTITIES),
        ("spike_count", synthetic.SPIKES),
    ):
        assert frame[column].between(low, high).all()
    assert frame[frame["symbol"] == "ETHUSDT"]["avg_price"].std() == pytest.approx(200, rel=0.4)
    again, _ = synthetic.synth_window_tables(spark, START)
    assert again.repartition(5).exceptAll(tumbling).isEmpty()
    margin = sliding.select(F.min(F.col("max_price") - F.col("avg_price")), F.max(F.col("avg_price") - F.col("min_price")))
    low, high = margin.first()
    assert low >= 50 and high <= 100


def test_reader_reads_all_depths_and_sorts(spark, synth, tmp_path):
    tumbling, _ = synth
    tumbling.filter("minute(window_start) < 30").write.parquet(str(tmp_path / "t" / "a"))
    tumbling.write.parquet(str(tmp_path / "t" / "b" / "c"))
    got = tables.read_window_table(spark, str(tmp_path / "t"))
    rows = [(r.window_start, r.symbol) for r in got.collect()]
    assert len(rows) == 180 and rows == sorted(rows)


def test_reader_without_files(spark, tmp_path):
    for path in (tmp_path, tmp_path / "absent"):
        empty = tables.read_window_table(spark, str(path))
        assert empty.schema == TUMBLING_TABLE and empty.isEmpty()
    assert tables.preview(spark, str(tmp_path)) is None


def test_reader_casts_other_writers_types(spark, tmp_path):
    frame = pd.DataFrame(
        {
            "window_start": pd.to_datetime(["2024-01-01 00:00:00.5"]).astype("datetime64[ns]"),
            "window_end": ["2024-01-01 00:01:00"],
            "symbol": ["A"],
            "sum_qty": [7],
            "trade_count": [3],
        }
    )
    frame.to_parquet(tmp_path / "data.parquet", index=False)
    row = tables.read_window_table(spark, str(tmp_path)).first()
    assert row.window_start == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert row.window_end == dt.datetime(2024, 1, 1, 0, 1)
    assert isinstance(row.sum_qty, float) and "spike_count" not in row.asDict()


def test_reader_concatenates_unlike_tables(spark, synth, tmp_path):
    for name, table in zip("ts", synth):
        table.write.parquet(str(tmp_path / name))
    both = tables.read_window_table(spark, str(tmp_path / "t"), str(tmp_path / "s"), dedup=False)
    assert both.count() == 360
    assert both.filter("min_price is null").count() == 180


def test_listing_opens_no_file(spark, synth, tmp_path):
    synth[0].repartition(3).write.partitionBy("event_date").parquet(str(tmp_path / "t"))
    listed = tables._listing(spark, str(tmp_path / "t"))
    scan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in scan
    rows = listed.collect()
    assert {r.folders for r in rows} == {"event_date"} and len({r.job for r in rows}) < len(rows)


def test_writes_of_unlike_types_in_one_folder(spark, synth, tmp_path):
    tumbling, path = synth[0], str(tmp_path / "t")
    minute = F.minute("window_start") % 3
    tumbling.filter(minute == 0).write.parquet(path)
    texts = {"window_start": F.col("window_start").cast("string"), "trade_count": F.col("trade_count").cast("int")}
    tumbling.filter(minute == 1).withColumns(texts).write.mode("append").parquet(path)
    tumbling.filter(minute == 2).drop("spike_count").repartition(5).write.mode("append").parquet(path)
    scans = tables._scans(spark, path)
    assert len(scans) == 3
    got = tables.read_window_table(spark, path)
    assert got.schema["trade_count"].dataType.simpleString() == "bigint"
    want = tumbling.withColumn("spike_count", F.when(minute != 2, F.col("spike_count")))
    shown = [c for c in TUMBLING_TABLE.names]
    assert sorted(map(str, got.select(shown).collect())) == sorted(map(str, want.select(shown).collect()))


def test_incomplete_sink_log(spark, synth, tmp_path):
    path = tmp_path / "t"
    synth[0].coalesce(1).write.parquet(str(path))
    log = path / "_spark_metadata"
    log.mkdir()
    data = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    entry = {"path": f"file://{path}/{data}", "size": 1, "isDir": False, "modificationTime": 1,
             "blockReplication": 1, "blockSize": 1, "action": "add"}
    (log / "12").write_text("v1\n" + json.dumps(entry))
    with pytest.raises(Exception):
        tables.read_window_table(spark, str(path), use_log=True).count()
    assert tables.read_window_table(spark, str(path)).count() == 180
    assert spark.conf.get("spark.sql.streaming.fileStreamSink.ignoreMetadata") == "false"


def test_preview(spark, synth, tmp_path, capsys):
    synth[0].write.parquet(str(tmp_path / "t"))
    assert tables.preview(spark, str(tmp_path / "t")).count() == 10
    assert "window_start" in capsys.readouterr().out


def test_symbol_choice(spark, synth):
    tumbling, _ = synth
    assert [r.symbol for r in reports.list_symbols(tumbling).collect()] == sorted(synthetic.BASE_PRICES)
    chosen = reports.filter_symbols(tumbling)
    assert {r.symbol for r in chosen.select("symbol").distinct().collect()} == {"BNBUSDT", "BTCUSDT"}
    assert reports.filter_symbols(tumbling, []).count() == 180
    assert reports.filter_symbols(tumbling, ["ETHUSDT"]).count() == 60


def test_symbol_filter_reaches_the_scan(spark, synth, tmp_path):
    synth[0].write.parquet(str(tmp_path / "t"))
    table = tables.read_window_table(spark, str(tmp_path / "t"), dedup=False, sort=False)
    plan = reports.filter_symbols(table, ["ETHUSDT"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,ETHUSDT)" in plan


def test_latest_window_and_kpis(spark, synth):
    tumbling, _ = synth
    latest = reports.latest_window(tumbling).first()
    assert (latest.symbol, latest.window_start) == ("ETHUSDT", START + dt.timedelta(minutes=59))
    scored = tumbling.withColumns(
        {"predicted_price": F.col("avg_price") - 1, "anomaly": F.col("spike_count") == 4}
    )
    kpi = reports.kpi_summary(scored).first()
    assert (kpi.latest_symbol, kpi.direction, kpi.status) == ("ETHUSDT", "down", "anomalies")
    assert kpi.total_trades == sum(r.trade_count for r in tumbling.collect())
    assert kpi.anomaly_count == scored.filter("anomaly").count()
    nothing = reports.kpi_summary(tumbling.limit(0)).first()
    assert (nothing.latest_symbol, nothing.total_trades, nothing.status) == ("", 0, "normal")
    assert reports.latest_window(tumbling.limit(0)).count() == 0


def test_anomaly_table_has_the_columns_that_exist(synth):
    scored = synth[0].withColumns({"anomaly": F.col("spike_count") == 4, "anomaly_score": F.lit(-0.1)})
    report = reports.anomaly_table(scored.drop("spike_count").withColumn("anomaly", F.lit(True)))
    assert report.columns == [c for c in C.ANOMALY_REPORT_COLUMNS if c != "spike_count"]
    normal, anomalous = reports.split_anomalies(scored)
    assert normal.count() + anomalous.count() == 180


def test_series(synth):
    series = reports.series_long(synth[0])
    counts = {r.measure: r["count"] for r in series.groupBy("measure").count().collect()}
    assert counts == dict.fromkeys(("avg_price", "trade_count", "sum_value", "spike_count"), 180)


def test_range_band(synth):
    rows = reports.range_band(synth[1]).collect()
    keys = [(r.symbol, r.window_start) for r in rows]
    assert keys == sorted(keys) and all(r.min_price < r.avg_price < r.max_price for r in rows)


def test_peek(spark):
    records = spark.createDataFrame(
        [('{"symbol":"A","price":1.5,"is_price_spike":true}',), ("{}",)], "json_str string"
    )
    spike, empty = reports.peek_trades(records).collect()
    assert (spike.symbol, spike.price, spike.quantity, spike.marker) == ("A", 1.5, 0.0, "SPIKE")
    assert (empty.symbol, empty.price, empty.time, empty.marker) == ("?", 0.0, "?", "")
    assert reports.peek_trades(records, limit=1).count() == 1
    assert reports.message_count(records).first().messages == 2


def test_quality_report(spark, synth, trades):
    table = trades(("BTCUSDT", 1.0, 1, 1), ("BTCUSDT", -1.0, 2, 2)).withColumn("is_price_spike", F.lit(True))
    report = {r.check_name: (r.ok, r.value) for r in quality.quality_report(table, synth[0]).collect()}
    assert report["non_positive_rows"] == (False, 1)
    assert report["missing_symbols"] == (True, 0)
    assert report["window_span_seconds"] == (True, 59 * 60)
    assert report["spikes_flagged"] == (True, 2)
    none = {r.check_name: r.ok for r in quality.quality_report(table.limit(0), synth[0].limit(0)).collect()}
    assert not none["missing_symbols"] and not none["trades_counted"]


def test_settings(tmp_path):
    assert load_settings({}).sink == "console" and load_settings({"SINK": " "}).sink == "console"
    given = load_settings({"SINK": "PARQUET", "OUTPUT_DIR": "s3a://bucket/out", "WATERMARK": "5 minutes"})
    assert (given.sink, given.watermark) == ("parquet", "5 minutes")
    assert given.output_path("t") == "s3a://bucket/out/t"
    assert os.path.isabs(load_settings({}).checkpoint_dir)


def test_topic_options():
    options = topics.topic_options(Settings())
    assert options == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "clean_trades",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert topics.topic_sink_options(Settings(), "raw_trades")["topic"] == "raw_trades"


def test_clean_schema():
    assert len(CLEAN_TRADE.names) == 10
