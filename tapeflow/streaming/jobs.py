"""Streaming queries: sources to layers, clean trades to window tables, tables to scores."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from .. import constants as C
from ..operators.ingest import enrich_trades, split_rejects, to_records, unwrap_messages, validate_trades
from ..operators.blocks import PART, POS
from ..operators.dedup import dedup_windows
from ..operators.price_state import PriceState, merge_windows, no_prices, out_of_order, predict_from_state
from ..operators.spikes import ARRIVAL
from ..operators.stats import running_totals, totals_stats
from ..operators.windows import (
    aggregate_sliding,
    aggregate_tumbling,
    clean_trades,
    parse_clean_trades,
)
from ..plans.pipelines import score_windows
from ..schemas import TUMBLING_TABLE
from ..session import delete_siblings, durable, list_names, temporary_tables, touch
from ..settings import Settings
from ..sources.tables import read_window_table
from ..sources.topics import in_arrival_order, read_trade_stream, topic_sink_options, with_short_arrival
from .state import mark_batch, no_memory

Trigger = Mapping[str, object]
SINKS = ("console", "parquet", "updates")
_CONSOLE_ROWS = 50


def _start(writer: DataStreamWriter, checkpoint: str, trigger: Trigger | None) -> StreamingQuery:
    """Without a trigger the next micro-batch starts as soon as the last one ends;
    ``{"availableNow": True}`` works through what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _layer(
    df: DataFrame, topic: str, settings: Settings, to_topic: bool, trigger: Trigger | None
) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").queryName(topic)
    if to_topic:
        writer = writer.format("kafka").options(**topic_sink_options(settings, topic))
    else:
        writer = writer.format("parquet").option("path", settings.output_path(topic))
    return _start(writer, settings.checkpoint_path(topic), trigger)


def write_raw(
    messages: DataFrame,
    settings: Settings,
    value: str = "json_str",
    to_topic: bool = False,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Store each unwrapped message before any check; unreadable text is kept and marked in the
    parquet layer."""
    unwrapped = unwrap_messages(messages, value)
    if to_topic:
        raw = unwrapped.filter("parse_ok").select(F.col("raw").alias("value"))
    else:
        raw = unwrapped.select(F.col(value).alias("message"), "raw", "parse_ok")
    return _layer(raw, C.RAW_TOPIC, settings, to_topic, trigger)


def start_ingest(
    messages: DataFrame,
    settings: Settings,
    value: str = "json_str",
    horizon: int = C.DEDUP_HORIZON,
    threshold_pct: float = C.SPIKE_THRESHOLD_PCT,
    interval: int = C.STATS_INTERVAL,
    order_by: Sequence[str] | None = None,
    source: str = C.SOURCE_NAME,
    to_topic: bool = False,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Messages to accepted and rejected trades with their statistics, in one query.

    Each micro-batch writes a folder ``batch=N`` of every table: the accepted trades as JSON records (to the topic, if
    asked), ``rejects`` with their messages and reasons, duplicates included, ``reject_counts``, ``symbol_stats`` (all
    trades so far) and ``stats_intervals``. Rows are taken in ``order_by``: as they arrived if ``messages`` have
    ``arrival``, else by time and id.

    The memory of ids and prices and the totals are tables beside the checkpoint, one for each micro-batch, read by the
    next one. A micro-batch that is run again after a failure starts from the same tables and replaces its own
    folders, so nothing counts twice; only a topic may get records twice.
    """
    spark = messages.sparkSession
    arrival = "arrival" in messages.columns
    order = list(order_by or (["arrival"] if arrival else ARRIVAL))
    state = settings.checkpoint_path(C.CLEAN_TOPIC) + "/carried"

    def carried(name: str, batch_id: int) -> DataFrame | None:
        return spark.read.parquet(f"{state}/{name}/batch={batch_id - 1}") if batch_id else None

    def keep(table: DataFrame, path: str, batch_id: int) -> DataFrame:
        table.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        return spark.read.schema(table.schema).parquet(f"{path}/batch={batch_id}")

    def run(batch: DataFrame, batch_id: int) -> None:
        with temporary_tables(spark):
            placed = in_arrival_order(batch) if arrival else batch
            checked = durable(validate_trades(unwrap_messages(placed, value)).drop("raw", "parse_ok"))
            accepted, refused = split_rejects(checked)
            # Rows are read in the order of arrival, so they need no sort, and it leaves no ties for the text to break.
            apart = order == ["arrival"]
            if apart:
                at = {PART: F.col("arrival.block"), POS: F.col("arrival.row")}
                accepted = with_short_arrival(accepted.drop(value)).withColumns(at).drop("arrival")
            memory = carried("memory", batch_id)
            marked, memory = mark_batch(
                accepted, no_memory(spark) if memory is None else memory, horizon, threshold_pct, order
            )
            clean = to_records(enrich_trades(marked.filter("not is_duplicate"), source))
            if to_topic:
                clean.write.format("kafka").options(**topic_sink_options(settings, C.CLEAN_TOPIC)).save()
            else:
                keep(clean, settings.output_path(C.CLEAN_TOPIC), batch_id)
            copies = marked.filter("is_duplicate").withColumn("reject_reason", F.lit(C.DUPLICATE))
            if apart:
                # A row has its number in the whole micro-batch.
                copies = durable(copies.select("symbol", "trade_id", "timestamp_ms", "reject_reason", POS))
                copies = copies.join(checked.select(F.col("arrival.row").alias(POS), value), POS).drop(POS)
                refused = refused.drop("arrival")
            rejects = refused.unionByName(copies, allowMissingColumns=True)
            seen = Observation("rejects")
            counted = rejects.observe(seen, *[F.count_if(F.col("reject_reason") == r).alias(r) for r in C.REJECT_REASONS])
            names = [value, "symbol", "trade_id", "timestamp_ms", "missing_keys", "reject_reason"]
            keep(counted.select(*names), settings.output_path("rejects"), batch_id)
            counts = [(reason, n) for reason, n in seen.get.items() if n]
            counts = spark.createDataFrame(counts, "reject_reason string, rejected bigint")
            keep(counts.coalesce(1), settings.output_path("reject_counts"), batch_id)
            totals = running_totals(marked, interval, order, carried=carried("totals", batch_id))
            keep(totals.intervals, settings.output_path("stats_intervals"), batch_id)
            left = keep(totals.carried, f"{state}/totals", batch_id)
            keep(totals_stats(left), settings.output_path("symbol_stats"), batch_id)
            keep(memory, f"{state}/memory", batch_id)
        for name in ("totals", "memory"):  # the batch before stays, in case this one has to run again
            delete_siblings(spark, f"{state}/{name}/batch={batch_id}", (f"batch={batch_id - 1}",))

    writer = messages.writeStream.queryName("ingest").foreachBatch(run)
    return _start(writer, settings.checkpoint_path(C.CLEAN_TOPIC), trigger)


def start_window_query(
    windows: DataFrame,
    table: str,
    settings: Settings,
    trigger: Trigger | None = None,
    partition_by: str | None = None,
    files_per_batch: int | None = None,
    files_per_date: int = 4,
) -> StreamingQuery:
    """Start one window table into the sink of the settings: updates on the console (``console``), finished
    windows appended as parquet (``parquet``), or updates as parquet, a folder ``batch=N`` for each micro-batch, to be
    read with :func:`latest_updates` (``updates``).

    Window rows are gathered by date before they are written, not one file per shuffle
    partition. A date is dealt over ``files_per_date`` tasks, so that it is never one task however many windows it
    has. ``files_per_batch=1`` suits a live stream, whose micro-batches finish a few windows of each symbol.
    """
    share = F.pmod(F.xxhash64("symbol", "window_start"), F.lit(files_per_date))
    if settings.sink == "console":
        writer = windows.writeStream.format("console").outputMode("update")
        writer = writer.option("numRows", _CONSOLE_ROWS).option("truncate", "false")
    elif settings.sink == "parquet":
        rows = windows.repartition(*([files_per_batch] if files_per_batch else []), "event_date", share)
        writer = rows.writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", settings.output_path(table))
        if partition_by:
            writer = writer.partitionBy(partition_by)
    elif settings.sink == "updates":
        path = settings.output_path(table)

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.repartition("event_date", share).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

        writer = windows.writeStream.outputMode("update").foreachBatch(write)
    else:
        raise ValueError(f"unknown sink {settings.sink!r}: expected one of {', '.join(SINKS)}")
    writer = writer.queryName(f"{table}_{settings.sink}")
    return _start(writer, settings.checkpoint_path(table), trigger)


def latest_updates(spark: SparkSession, settings: Settings, table: str) -> DataFrame:
    """The newest values of every window of a table that a query with the sink ``updates`` writes, unfinished windows
    included."""
    rows = spark.read.parquet(settings.output_path(table))
    values = F.struct(*[c for c in rows.columns if c not in ("window_start", "symbol", "batch")])
    newest = rows.groupBy("window_start", "symbol").agg(F.max_by(values, "batch").alias("_row"))
    return newest.select("window_start", "symbol", "_row.*").select(*[c for c in rows.columns if c != "batch"])


def start_pipeline(
    spark: SparkSession,
    settings: Settings,
    json_dir: str | None = None,
    max_per_trigger: int | None = None,
    dedup: str | None = "unbounded",
    trigger: Trigger | None = None,
    partition_by: str | None = None,
    files_per_batch: int | None = None,
) -> list[StreamingQuery]:
    """Both window tables from one stream of clean trades, each with its own checkpoint. Wait
    with ``spark.streams.awaitAnyTermination()``, which reports the first query that fails."""
    if settings.sink not in SINKS:
        raise ValueError(f"unknown sink {settings.sink!r}: expected one of {', '.join(SINKS)}")
    messages = read_trade_stream(spark, settings, json_dir, max_per_trigger)
    trades = clean_trades(parse_clean_trades(messages), settings.watermark, dedup)
    tables = {C.TUMBLING_NAME: aggregate_tumbling(trades), C.SLIDING_NAME: aggregate_sliding(trades)}
    return [
        start_window_query(windows, table, settings, trigger, partition_by, files_per_batch)
        for table, windows in tables.items()
    ]


class LateRows(StreamingQueryListener):
    """Counts the rows that stateful operators drop behind the watermark, over the whole life of a query.

    Each micro-batch that drops rows leaves a file named after it in ``late_rows`` beside the query's checkpoint, so the
    count outlives the driver, and a micro-batch that is run again counts once. Attach the listener
    (``spark.streams.addListener``) before the queries of :func:`start_pipeline` start, and after a restart again.
    """

    def __init__(self, spark: SparkSession, settings: Settings) -> None:
        self._spark, self._settings = spark, settings

    def _folder(self, table: str) -> str:
        return f"{self._settings.checkpoint_path(table)}/late_rows"

    def total(self, table: str) -> int:
        """Rows dropped so far from a window table. Progress is reported in the background: of a query that ended,
        shortly after its end."""
        names = list_names(self._spark, self._folder(table))
        return sum(int(name.partition("-")[2]) for name in names if name[0] != ".")

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        table = next((t for t in (C.TUMBLING_NAME, C.SLIDING_NAME) if (event.progress.name or "").startswith(t)), None)
        if late and table:
            touch(self._spark, f"{self._folder(table)}/{event.progress.batchId}-{late}")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def refresh_scores(
    spark: SparkSession,
    settings: Settings,
    table: str = C.TUMBLING_NAME,
    name: str = "scores",
    symbols: list[str] | None = None,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Fit both models again over all windows so far whenever the window table has grown, and
    write the scored table. All symbols are scored unless some are given. A refresh has a folder
    of its own, to be read with :func:`latest_scores`; the one before stays for whoever reads it."""
    source = settings.output_path(table)

    def refresh(_: DataFrame, batch_id: int) -> None:
        with temporary_tables(spark):
            windows = read_window_table(spark, source, sort=False)
            scored = score_windows(windows, symbols)
            target = f"{settings.output_path(name)}/refresh={batch_id}"
            scored.write.mode("overwrite").parquet(target)
        delete_siblings(spark, target, (f"refresh={batch_id - 1}",))

    grown = spark.readStream.schema(TUMBLING_TABLE).parquet(source).select("window_start")
    writer = grown.writeStream.queryName(name).foreachBatch(refresh)
    return _start(writer, settings.checkpoint_path(name), trigger)


def latest_scores(spark: SparkSession, settings: Settings, name: str = "scores") -> DataFrame:
    """The table of the last refresh."""
    folder = settings.output_path(name)
    numbers = [int(n.partition("=")[2]) for n in list_names(spark, folder) if n.startswith("refresh=")]
    return spark.read.parquet(f"{folder}/refresh={max(numbers)}")


def refresh_prices(
    spark: SparkSession,
    settings: Settings,
    table: str = C.TUMBLING_NAME,
    name: str = "prices",
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Keep the price models up to date without reading the history again: whenever the window table has grown, the new windows
    are merged into the models' state, which is stored beside the checkpoint, and predicted with the new models, into a
    folder ``refresh=N``.

    Windows that come behind later ones of their symbol cannot be merged; then the state is made again from the whole table.
    """
    state_path = settings.checkpoint_path(name) + "/state"
    source = settings.output_path(table)

    def stored(batch_id: int) -> PriceState:
        path = f"{state_path}/refresh={batch_id}"
        return PriceState(spark.read.parquet(f"{path}/moments"), spark.read.parquet(f"{path}/tail"))

    def refresh(batch: DataFrame, batch_id: int) -> None:
        with temporary_tables(spark):
            new = durable(dedup_windows(batch))
            state = stored(batch_id - 1) if batch_id else no_prices(spark)
            if not out_of_order(state, new).isEmpty():
                state, new = no_prices(spark), durable(read_window_table(spark, source, sort=False))
            for part, rows in zip(("moments", "tail"), merge_windows(state, new)):
                rows.write.mode("overwrite").parquet(f"{state_path}/refresh={batch_id}/{part}")
            columns = ["symbol", "window_start", "avg_price", "sum_value"]
            every = state.tail.withColumn("_new", F.lit(False)).union(new.select(*columns, F.lit(True)))
            scored = predict_from_state(stored(batch_id), every).filter("_new").drop("_new")
            scored.write.mode("overwrite").parquet(f"{settings.output_path(name)}/refresh={batch_id}")
        delete_siblings(spark, f"{state_path}/refresh={batch_id}", (f"refresh={batch_id - 1}",))

    grown = spark.readStream.schema(TUMBLING_TABLE).parquet(source)
    writer = grown.writeStream.queryName(name).foreachBatch(refresh)
    return _start(writer, settings.checkpoint_path(name), trigger)
