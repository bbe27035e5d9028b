"""Every operator as a named query over the test tables."""

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import dedup as D
from ..operators import features as FE
from ..operators import ingest as I
from ..operators import price_state as PS
from ..operators import reports as R
from ..operators import stats as S
from ..operators import windows as W
from ..operators.forest import detect_anomalies
from ..operators.quality import quality_report as quality
from ..operators.regression import predict_prices as predict
from ..operators.regression import prediction_error as with_error
from ..operators.spikes import flag_spikes
from ..schemas import SLIDING_TABLE
from ..session import durable, durable_dir
from ..settings import Settings
from ..sources.adapters import events_as_trades, lineitem_as_trades
from ..sources.tables import preview, read_window_table
from ..sources.topics import read_trade_messages, read_trade_stream
from ..streaming import jobs
from ..streaming.backfill import close_windows, whole_table
from . import pipelines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles and render times as text, so that two engines can be compared. The small
    shift keeps exact ties (such as sixteenths of a cent) off the rounding edge."""
    shown = {"timestamp": "yyyy-MM-dd HH:mm:ss.SSS", "date": "yyyy-MM-dd"}
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "double":
            column = F.round(column + 10.0 ** -(digits + 3), digits)
        elif kind in shown:
            column = F.date_format(column, shown[kind])
        columns.append(column.alias(name))
    return df.select(*columns)


def query(digits: int = 6):
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return present(build(spark, sf_dir), digits)

        QUERIES[build.__name__] = run
        return build

    return register


# Inputs -------------------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_trades(spark.read.parquet(f"{sf_dir}/events.parquet"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_as_trades(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as raw messages (event_id, copy, value), a share of them spoiled in each way
    that a message can fail and a share sent twice."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")

    def every(n: int):
        return F.col("event_id") % n == 0

    data = F.struct(
        F.lit("trade").alias("e"),
        F.when(every(79), "").otherwise(F.col("event_type")).alias("s"),
        F.when(every(89), "abc").when(every(71), "NaN").otherwise(F.col("value").cast("string")).alias("p"),
        F.when(every(83), "0").otherwise((1.0 + F.col("user_id") % 10).cast("string")).alias("q"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("T"),
        F.when(~every(97), F.col("user_id") % 2 == 0).alias("m"),
        F.col("event_id").alias("t"),
    )
    text = F.to_json(F.struct(data.alias("data")))
    text = F.when(every(61), F.regexp_replace(text, '"m":(true|false)', '"m":"$1"')).otherwise(text)
    text = F.when(every(67), "not json").when(every(103), "{}").otherwise(text)
    once = table.select("event_id", F.lit(0).alias("copy"), text.alias("value"))
    return once.union(once.filter(every(59)).withColumn("copy", F.lit(1)))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window table for the models: one-hour windows of the events."""
    return durable(W.aggregate_tumbling(W.clean_trades(events(spark, sf_dir)), "1 hour"))


def scratch(spark: SparkSession, name: str) -> str:
    return f"{durable_dir(spark).rstrip('/')}/tapeflow/{name}-{uuid.uuid4().hex}"


# Ingest -------------------------------------------------------------------------------------


@query()
def unwrap_messages(spark, sf_dir):
    raw = I.unwrap_messages(messages(spark, sf_dir))
    return raw.select(
        "event_id",
        "copy",
        "parse_ok",
        (F.col("raw") == "{}").alias("is_empty"),
        F.coalesce(F.get_json_object("raw", "$.s"), F.lit("?")).alias("symbol"),
        F.coalesce(F.get_json_object("raw", "$.T"), F.lit("?")).alias("time_text"),
    )


@query()
def validate_trades(spark, sf_dir):
    checked = I.validate_trades(I.unwrap_messages(messages(spark, sf_dir)))
    accepted, _ = I.split_rejects(checked)
    return accepted.drop("value", "raw", "parse_ok")


@query()
def split_rejects(spark, sf_dir):
    checked = I.validate_trades(I.unwrap_messages(messages(spark, sf_dir)))
    _, refused = I.split_rejects(checked)
    return refused.select(
        "event_id", "copy", "reject_reason", F.array_join("missing_keys", ",").alias("missing_keys")
    )


@query()
def reject_report(spark, sf_dir):
    refused = pipelines.ingest_messages(messages(spark, sf_dir)).rejects
    return I.reject_report(refused)


@query()
def ingest_messages(spark, sf_dir):
    return pipelines.ingest_messages(messages(spark, sf_dir)).clean


@query()
def enrich_trades(spark, sf_dir):
    trades = lineitem(spark, sf_dir).drop("trade_value_usdt", "trade_time", "source")
    return I.enrich_trades(trades)


@query()
def duplicate_count(spark, sf_dir):
    return I.duplicate_count(lineitem(spark, sf_dir))


@query()
def dedup_recent(spark, sf_dir):
    return D.dedup_recent(lineitem(spark, sf_dir)).drop("event_time", "trade_time")


@query()
def mark_duplicates(spark, sf_dir):
    return D.mark_duplicates(lineitem(spark, sf_dir)).drop("event_time", "trade_time")


@query()
def dedup_recent_2000(spark, sf_dir):
    marked = D.mark_duplicates(lineitem(spark, sf_dir), C.DEDUP_HORIZON)
    return marked.drop("event_time", "trade_time")


@query()
def flag_spikes_by_time(spark, sf_dir):
    return flag_spikes(durable(events(spark, sf_dir).filter("price > 0"))).drop("event_time", "trade_time")


@query()
def flag_spikes_by_range(spark, sf_dir):
    trades = durable(D.dedup_recent(lineitem(spark, sf_dir)))
    return flag_spikes(trades, threshold_pct=50.0).drop("event_time", "trade_time")


@query(digits=2)
def symbol_stats(spark, sf_dir):
    marked = durable(pipelines.mark_trades(lineitem(spark, sf_dir)))
    rejects = marked.filter("is_duplicate").withColumn("reject_reason", F.lit(C.DUPLICATE))
    return S.symbol_stats(marked.filter("not is_duplicate"), rejects)


def stats_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trades, marked, with the columns that running statistics use. Trades that tie in these are interchangeable."""
    trades = lineitem(spark, sf_dir).select("symbol", "price", "quantity", "timestamp_ms", "trade_id")
    return durable(pipelines.mark_trades(trades, placed=True))


@query(digits=2)
def stats_snapshots(spark, sf_dir):
    return S.stats_snapshots(stats_trades(spark, sf_dir))


@query(digits=2)
def stats_intervals(spark, sf_dir):
    marked = stats_trades(spark, sf_dir)
    return S.running_totals(marked).intervals.fillna(-1, ["to_trades"])


@query(digits=2)
def stats_as_of(spark, sf_dir):
    marked = stats_trades(spark, sf_dir)
    return S.stats_at(durable(S.running_totals(marked).intervals), 3_750)


# Window tables ------------------------------------------------------------------------------


@query()
def parse_clean_trades(spark, sf_dir):
    records = I.to_records(events(spark, sf_dir).withColumn("symbol", F.lower("symbol")))
    return W.parse_clean_trades(records, "value")


@query()
def clean_trades(spark, sf_dir):
    return W.clean_trades(lineitem(spark, sf_dir)).drop("trade_time")


@query()
def tumbling_1m(spark, sf_dir):
    return W.aggregate_tumbling(W.clean_trades(events(spark, sf_dir)))


@query()
def sliding_5m_1m(spark, sf_dir):
    return W.aggregate_sliding(W.clean_trades(events(spark, sf_dir)))


@query()
def sliding_5m_1m_expanded(spark, sf_dir):
    return W.aggregate_sliding(W.clean_trades(events(spark, sf_dir)), from_partials=False)


@query(digits=2)
def tumbling_1m_lineitem(spark, sf_dir):
    trades = durable(W.clean_trades(lineitem(spark, sf_dir)))
    return W.aggregate_tumbling(flag_spikes(trades))


@query()
def dedup_windows(spark, sf_dir):
    trades = W.valid_trades(events(spark, sf_dir))
    early = W.aggregate_tumbling(trades.filter("price > 50"), "1 hour")
    return D.dedup_windows(W.aggregate_tumbling(trades, "1 hour").union(early))


@query()
def read_window_table_files(spark, sf_dir):
    path = scratch(spark, "windows")
    trades = W.valid_trades(events(spark, sf_dir))
    W.aggregate_tumbling(trades).write.parquet(f"{path}/first")
    W.aggregate_tumbling(trades.filter("price > 50")).write.parquet(f"{path}/second")
    return read_window_table(spark, path)


@query()
def read_window_table_mixed(spark, sf_dir):
    """A folder with partition folders, files that lack a column and files of other types."""
    path = scratch(spark, "windows")
    table = durable(W.aggregate_tumbling(W.valid_trades(events(spark, sf_dir))))
    third = F.minute("window_start") % 3
    table.filter(third == 0).write.partitionBy("event_date").parquet(f"{path}/by_date")
    table.filter(third == 1).drop("spike_count").write.parquet(f"{path}/plain")
    other = {"sum_qty": F.col("sum_qty").cast("int"), "window_start": F.col("window_start").cast("string")}
    table.filter(third == 2).withColumns(other).write.mode("append").parquet(f"{path}/plain")
    return read_window_table(spark, path).fillna(-1)


@query()
def concat_window_tables(spark, sf_dir):
    trades = durable(W.valid_trades(events(spark, sf_dir)))
    paths = [scratch(spark, "tumbling"), scratch(spark, "sliding")]
    W.aggregate_tumbling(trades).write.parquet(paths[0])
    W.aggregate_sliding(trades).write.parquet(paths[1])
    both = read_window_table(spark, *paths, dedup=False, sort=False)
    return both.fillna(-1)


@query()
def preview_window_table(spark, sf_dir):
    path = scratch(spark, "windows")
    W.aggregate_tumbling(W.valid_trades(events(spark, sf_dir))).write.parquet(path)
    return preview(spark, path)


# Features, models, reports ------------------------------------------------------------------


@query()
def window_features(spark, sf_dir):
    return FE.window_features(hourly(spark, sf_dir))


@query()
def standardize(spark, sf_dir):
    windows = FE.window_features(hourly(spark, sf_dir))
    scaled = FE.standardize(windows, C.ANOMALY_FEATURES)
    return scaled.select("symbol", "window_start", *[f"{c}_scaled" for c in C.ANOMALY_FEATURES])


@query()
def price_features(spark, sf_dir):
    return FE.price_features(hourly(spark, sf_dir)).fillna(-1.0, ["next_price"])


@query(digits=4)
def predict_prices(spark, sf_dir):
    return predict(hourly(spark, sf_dir)).select("symbol", "window_start", "predicted_price")


@query(digits=4)
def predict_prices_merged(spark, sf_dir):
    """The models of three refreshes by time, each merged into the state of those before."""
    windows = hourly(spark, sf_dir)
    state = PS.no_prices(spark)
    for low, high in (("2024-01-01", "2024-01-09"), ("2024-01-09", "2024-01-20"), ("2024-01-20", "2100-01-01")):
        state = PS.PriceState(*map(durable, PS.merge_windows(state, windows.filter(F.col("event_date").between(low, high) & (F.col("event_date") != high)))))
    return PS.predict_from_state(state, windows).select("symbol", "window_start", "predicted_price")


@query(digits=4)
def prediction_error(spark, sf_dir):
    scored = with_error(predict(hourly(spark, sf_dir)))
    return scored.select(
        "symbol", "window_start", "pred_error", F.coalesce("pred_error_aligned", F.lit(-1.0)).alias("aligned")
    )


@query()
def isolation_forest(spark, sf_dir):
    scored = detect_anomalies(hourly(spark, sf_dir))
    return scored.select("symbol", "window_start", "anomaly", "anomaly_score")


@query()
def anomaly_report(spark, sf_dir):
    return R.anomaly_table(detect_anomalies(hourly(spark, sf_dir)))


@query(digits=4)
def score_windows(spark, sf_dir):
    return pipelines.score_windows(hourly(spark, sf_dir)).fillna(-1, ["pred_error_aligned"])


@query()
def list_symbols(spark, sf_dir):
    return R.list_symbols(W.aggregate_tumbling(events(spark, sf_dir)))


@query()
def filter_symbols(spark, sf_dir):
    return R.filter_symbols(hourly(spark, sf_dir))


@query()
def latest_window(spark, sf_dir):
    return R.latest_window(hourly(spark, sf_dir))


@query(digits=2)
def kpi_summary(spark, sf_dir):
    return R.kpi_summary(predict(hourly(spark, sf_dir)))


@query(digits=2)
def kpi_summary_scored(spark, sf_dir):
    return R.kpi_summary(pipelines.score_windows(hourly(spark, sf_dir)))


@query()
def range_band(spark, sf_dir):
    return R.range_band(W.aggregate_sliding(W.clean_trades(events(spark, sf_dir))))


@query()
def series_long(spark, sf_dir):
    return R.series_long(hourly(spark, sf_dir))


@query(digits=4)
def series_long_scored(spark, sf_dir):
    return R.series_long(pipelines.score_windows(hourly(spark, sf_dir)))


@query()
def peek_trades(spark, sf_dir):
    trades = events(spark, sf_dir)
    trades = trades.withColumn("price", F.when(F.col("trade_id") % 7 > 0, F.col("price")))
    trades = trades.withColumn("is_price_spike", F.col("trade_id") % 5 == 0)
    return R.peek_trades(I.to_records(trades).select(F.col("value").alias("json_str")))


@query()
def message_count(spark, sf_dir):
    return R.message_count(I.to_records(lineitem(spark, sf_dir)))


@query()
def quality_report(spark, sf_dir):
    trades = durable(flag_spikes(durable(W.clean_trades(events(spark, sf_dir)))))
    return quality(trades, W.aggregate_tumbling(trades), ["CLICK", "VIEW", "NONE"])


# Streams ------------------------------------------------------------------------------------


def run_stream(spark: SparkSession, sf_dir: str, table: str, closed: bool = True) -> DataFrame:
    """The window pipeline over all events as JSON lines, then its parquet table: the closed windows, or all."""
    source = scratch(spark, "records")
    I.to_records(events(spark, sf_dir)).select("value").write.text(source)
    settings = Settings(
        sink="parquet",
        output_dir=scratch(spark, "tables"),
        checkpoint_dir=scratch(spark, "progress"),
    )
    trades = W.clean_trades(W.parse_clean_trades(read_trade_stream(spark, json_dir=source)))
    build = W.aggregate_tumbling if table == C.TUMBLING_NAME else W.aggregate_sliding
    jobs.start_window_query(build(trades), table, settings, {"availableNow": True}).awaitTermination()
    if not closed:
        close_windows(spark, settings, table)
        return whole_table(spark, settings, table)
    schema = {} if table == C.TUMBLING_NAME else {"schema": SLIDING_TABLE}
    return read_window_table(spark, settings.output_path(table), use_log=True, sort=False, **schema)


@query()
def stream_tumbling_1m(spark, sf_dir):
    return run_stream(spark, sf_dir, C.TUMBLING_NAME)


@query()
def stream_sliding_5m_1m(spark, sf_dir):
    return run_stream(spark, sf_dir, C.SLIDING_NAME)


@query()
def backfill_tumbling_1m(spark, sf_dir):
    return run_stream(spark, sf_dir, C.TUMBLING_NAME, closed=False)


@query()
def backfill_sliding_5m_1m(spark, sf_dir):
    return run_stream(spark, sf_dir, C.SLIDING_NAME, closed=False)


def run_pipeline(spark: SparkSession, sf_dir: str, sink: str) -> Settings:
    """Both window queries through `start_pipeline` over all events in four waves by time, each a micro-batch, restarted from
    their checkpoints. Every 13th id comes again one wave later, and with the last wave come rows of the first day."""
    source = scratch(spark, "records")
    settings = Settings(sink=sink, output_dir=scratch(spark, "tables"), checkpoint_dir=scratch(spark, "progress"))
    trades = durable(events(spark, sf_dir).filter("price > 0"))
    last = trades.agg(F.max("trade_id")).first()[0]
    wave = F.floor(F.col("trade_id") * 4 / F.lit(last + 1))
    every = trades.withColumn("wave", wave)
    copies = every.filter("trade_id % 13 = 0 AND wave < 3").withColumn("wave", F.col("wave") + 1)
    # A copy is of its own wave's time, so only its id gives it away.
    starts = every.groupBy("wave").agg(F.max("timestamp_ms").alias("at"))
    copies = copies.join(starts, "wave").withColumn("timestamp_ms", F.col("at")).select(*every.columns)
    late = every.filter("wave = 0 AND trade_id % 17 = 0")
    late = late.withColumns({"trade_id": F.col("trade_id") + 1_000_000_000, "wave": F.lit(3).cast("bigint")})
    rows = durable(every.unionByName(copies).unionByName(late))
    for number in range(4):
        wave_rows = I.to_records(rows.filter(F.col("wave") == number))
        wave_rows.select("value").write.text(f"{source}/wave{number}")
        started = jobs.start_pipeline(spark, settings, json_dir=f"{source}/*", trigger={"availableNow": True})
        for running in started:
            running.awaitTermination()
    return settings


@query()
def stream_pipeline_tumbling(spark, sf_dir):
    settings = run_pipeline(spark, sf_dir, "parquet")
    return read_window_table(spark, settings.output_path(C.TUMBLING_NAME), use_log=True, sort=False)


@query()
def stream_pipeline_updates(spark, sf_dir):
    settings = run_pipeline(spark, sf_dir, "updates")
    return jobs.latest_updates(spark, settings, C.SLIDING_NAME)


# Messages that arrive in an order of their own.
HORIZON = 600


def arriving(spark: SparkSession, sf_dir: str, number: int, path: str) -> None:
    """One of three waves of the raw messages as files of lines, in an order that has nothing to do with time. Copies of a
    message come in another wave than the message."""
    wave = messages(spark, sf_dir).filter((F.col("event_id") + F.col("copy")) % 3 == number)
    order = [(F.col("event_id") * 31 % 1009).alias("k"), "event_id", "copy"]
    rows = durable(wave.select(*order, "value"))
    files = max(4, -(-rows.count() // 250_000))
    rows.repartitionByRange(files, "k", "event_id", "copy").sortWithinPartitions("k", "event_id", "copy").select(
        "value"
    ).write.text(f"{path}/wave{number}")


@query()
def ingest_by_arrival(spark, sf_dir):
    source = scratch(spark, "messages")
    for number in range(3):
        arriving(spark, sf_dir, number, source)
    found = durable(read_trade_messages(spark, json_dir=f"{source}/*", arrival=True))
    return pipelines.ingest_messages(found, "json_str", HORIZON, order_by=["arrival"]).clean


def run_ingest(spark: SparkSession, sf_dir: str) -> Settings:
    """The ingest query over three waves, each a micro-batch, restarted from its checkpoint."""
    source = scratch(spark, "messages")
    settings = Settings(
        sink="parquet", output_dir=scratch(spark, "layers"), checkpoint_dir=scratch(spark, "progress")
    )
    for number in range(3):
        arriving(spark, sf_dir, number, source)
        stream = read_trade_stream(spark, json_dir=f"{source}/*", arrival=True)
        jobs.start_ingest(stream, settings, horizon=HORIZON, trigger={"availableNow": True}).awaitTermination()
    return settings


@query()
def stream_clean_layer(spark, sf_dir):
    records = spark.read.parquet(run_ingest(spark, sf_dir).output_path(C.CLEAN_TOPIC))
    return W.parse_clean_trades(records, "value").drop("event_time")


@query()
def stream_rejects(spark, sf_dir):
    rejects = spark.read.parquet(run_ingest(spark, sf_dir).output_path("rejects"))
    return rejects.select("reject_reason", F.coalesce("trade_id", F.lit(-1)).alias("trade_id"))


@query()
def stream_reject_counts(spark, sf_dir):
    counts = spark.read.parquet(run_ingest(spark, sf_dir).output_path("reject_counts"))
    return counts.groupBy("reject_reason").agg(F.sum("rejected").alias("rejected"))


@query(digits=2)
def stream_stats_snapshots(spark, sf_dir):
    intervals = spark.read.parquet(run_ingest(spark, sf_dir).output_path("stats_intervals")).drop("batch")
    return S.every_snapshot(intervals)


@query()
def stream_raw_layer(spark, sf_dir):
    source = scratch(spark, "messages")
    messages(spark, sf_dir).select("value").write.text(source)
    settings = Settings(
        sink="parquet", output_dir=scratch(spark, "layers"), checkpoint_dir=scratch(spark, "progress")
    )
    jobs.write_raw(read_trade_stream(spark, json_dir=source), settings, trigger={"availableNow": True}).awaitTermination()
    raw = spark.read.parquet(settings.output_path(C.RAW_TOPIC))
    return raw.select(
        "parse_ok",
        (F.col("raw") == "{}").alias("is_empty"),
        F.coalesce(F.get_json_object("raw", "$.T"), F.lit("?")).alias("time_text"),
    )


@query()
def read_messages(spark, sf_dir):
    source = scratch(spark, "records")
    I.to_records(events(spark, sf_dir)).select("value").write.text(source)
    records = read_trade_messages(spark, json_dir=source)
    return W.valid_trades(W.parse_clean_trades(records)).drop("event_time")
