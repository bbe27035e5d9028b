"""The windows that a finished append query kept back.

Append mode writes a window when the watermark has passed its end, so the last windows of an input that ended stay
in the state of the query. They are read from there; nothing is aggregated again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.dedup import dedup_windows
from ..schemas import SLIDING_TABLE, TUMBLING_TABLE
from ..settings import Settings
from ..sources.tables import read_window_table

_SCHEMAS = {C.TUMBLING_NAME: TUMBLING_TABLE, C.SLIDING_NAME: SLIDING_TABLE}
#: What the state holds for each table, in the order of its measures; a mean is a sum and a count.
_STATE = {
    C.TUMBLING_NAME: "n bigint, price_sum double, prices bigint, qty double, value double, spikes bigint",
    C.SLIDING_NAME: "n bigint, price_sum double, prices bigint, least double, greatest double, value double",
}
_MEASURES = {
    C.TUMBLING_NAME: {"sum_qty": "qty", "sum_value": "value", "spike_count": "spikes"},
    C.SLIDING_NAME: {"min_price": "least", "max_price": "greatest", "sum_value": "value"},
}


def open_windows(spark: SparkSession, settings: Settings, table: str) -> DataFrame:
    """The windows in the state of a query of :func:`jobs.start_window_query` that does not run. One task reads one
    partition of the state."""
    checkpoint = settings.checkpoint_path(table)
    operators = spark.read.format("state-metadata").load(checkpoint).filter("operatorName = 'stateStoreSave'")
    saved = operators.select("operatorId").distinct().first()
    schema = _SCHEMAS[table]
    if saved is None:  # no micro-batch yet
        return spark.createDataFrame([], schema)
    state = spark.read.format("statestore").option("operatorId", saved.operatorId).load(checkpoint)
    kind = ", ".join(f"{n}: {t}" for n, t in (c.split() for c in _STATE[table].split(", ")))
    rows = state.select("key.*", F.col("value").cast(f"struct<{kind}>").alias("v")).select("window.*", "symbol", "v.*")
    measures = {"trade_count": F.col("n"), "avg_price": F.try_divide("price_sum", "prices")}
    measures |= {name: F.col(of) for name, of in _MEASURES[table].items()}
    known = {"window_start": F.col("start"), "window_end": F.col("end"), "event_date": F.to_date("start")} | measures
    return rows.select(*[known.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def close_windows(spark: SparkSession, settings: Settings, table: str) -> str:
    """Write the open windows beside the table, replacing those of an earlier call, and give the folder. The table's sink log stays as it
    is: a query that goes on later finishes its windows itself."""
    path = settings.output_path(f"{table}_open")
    open_windows(spark, settings, table).write.mode("overwrite").parquet(path)
    return path


def whole_table(spark: SparkSession, settings: Settings, table: str) -> DataFrame:
    """All windows: the finished ones of the sink log and the open ones of :func:`close_windows`, of which those that
    have been finished since give way to the larger count."""
    finished = read_window_table(
        spark, settings.output_path(table), schema=_SCHEMAS[table], use_log=True, dedup=False, sort=False
    )
    still_open = spark.read.schema(_SCHEMAS[table]).parquet(settings.output_path(f"{table}_open"))
    return dedup_windows(finished.unionByName(still_open))
