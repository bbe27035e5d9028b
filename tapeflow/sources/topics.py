"""Trade messages from a topic or from a directory of JSON lines, and back."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import durable
from ..settings import Settings

BLOCK_ROWS = 1 << 16


def topic_options(settings: Settings) -> dict[str, str]:
    """Reader options of the topic source. The connector is a package of the Spark project that
    the job is submitted with."""
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic,
        "startingOffsets": settings.starting_offsets,
        "failOnDataLoss": "false",
    }


def topic_sink_options(settings: Settings, topic: str) -> dict[str, str]:
    """Writer options of a topic sink; a write is confirmed by all replicas."""
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "kafka.acks": "all",
        "topic": topic,
    }


def read_trade_stream(
    spark: SparkSession,
    settings: Settings | None = None,
    json_dir: str | None = None,
    max_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
    arrival: bool = False,
) -> DataFrame:
    """Stream of messages as text in ``json_str``: the topic of ``settings``, or new files of
    ``json_dir`` with one message per line. ``max_per_trigger`` bounds a micro-batch (offsets or
    files). ``arrival`` adds where a message came from, see :func:`in_arrival_order`."""
    reader = spark.readStream
    if json_dir is None:
        reader = reader.format("kafka").options(**topic_options(settings or Settings()))
        limit = "maxOffsetsPerTrigger"
    else:
        reader = reader.format("text")
        limit = "maxFilesPerTrigger"
    if max_per_trigger:
        reader = reader.option(limit, max_per_trigger)
    reader = reader.options(**(options or {}))
    messages = reader.load() if json_dir is None else reader.load(json_dir)
    return _select(messages, json_dir, arrival)


def read_trade_messages(
    spark: SparkSession, settings: Settings | None = None, json_dir: str | None = None, arrival: bool = False
) -> DataFrame:
    """The same as a table, for backfills: the whole topic up to now, or all files. With ``arrival``, in the order
    of ``arrival`` of :func:`in_arrival_order`."""
    if json_dir is not None:
        messages = spark.read.text(json_dir)
    else:
        options = topic_options(settings or Settings()) | {"startingOffsets": "earliest"}
        messages = spark.read.format("kafka").options(**options).load()
    found = _select(messages, json_dir, arrival)
    return in_arrival_order(found) if arrival else found


def _select(messages: DataFrame, json_dir: str | None, arrival: bool) -> DataFrame:
    columns = [F.col("value").cast("string").alias("json_str")]
    if arrival:
        place = ["partition", "offset"]
        if json_dir is not None:
            place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
        columns.append(F.struct(*place).alias("arrival"))
    return messages.select(*columns)


def in_arrival_order(messages: DataFrame) -> DataFrame:
    """Complete ``arrival``, by which rows can be ordered as they came: for files the path, the start of the block
    and the row in the block; for a topic the partition and the offset.

    Rows of a block are read by one task in their order and numbered there, so this must directly follow the
    source, and the result must be stored before it is used twice. A stream numbers its rows inside a micro-batch.
    """
    row = F.monotonically_increasing_id().alias("row")
    return messages.withColumn("arrival", F.struct("arrival.*", row))


def with_short_arrival(stored: DataFrame) -> DataFrame:
    """A stored table with the complete ``arrival`` as two numbers in the same order, the block and the row: paths are long to
    carry and to compare. A block is a run of rows that one task read in their order, of a file or a partition, and holds
    ``BLOCK_ROWS`` at most, however large a file is. Blocks meet in one place, a row each."""
    names = stored.schema["arrival"].dataType.names
    at = [F.col(f"arrival.{n}").alias(f"_{n}") for n in names if n not in ("offset", "row")]
    at.append(F.floor(F.col("arrival.row") / BLOCK_ROWS).alias("_run"))
    rows = stored.withColumn("_at", F.struct(*at))
    first = F.min("arrival.offset" if "offset" in names else "arrival.row").alias("_first")
    blocks = rows.groupBy("_at").agg(first).select("_at.*", "_first")
    order = [c for c in blocks.columns if c not in ("_run", "_first")]
    number = F.row_number().over(Window.orderBy(*order, "_first")).cast("bigint").alias("_block")
    blocks = durable(blocks.select(F.struct(*[c for c in blocks.columns if c != "_first"]).alias("_at"), number))
    numbered = rows.join(blocks, "_at")
    return numbered.withColumn("arrival", F.struct(F.col("_block").alias("block"), "arrival.row")).select(*stored.columns)
