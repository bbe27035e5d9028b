"""From message text to clean trades."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import columns as X
from ..schemas import CLEAN_TRADE

_FIELDS = "fields"


def unwrap_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Take the trade out of its envelope.

    Adds ``parse_ok``, ``raw`` (text of the ``data`` member, ``{}`` if absent) and ``fields``
    (its members by case-sensitive key, with their JSON types). The text is parsed once for the
    fields; ``raw`` is only computed where a later step asks for it.
    """
    text = F.col(value).cast("string")
    envelope = F.from_json(
        text,
        "data map<string,variant>, unread string",
        {"columnNameOfCorruptRecord": "unread"},
    )
    # JSON of another shape than an envelope is valid text all the same.
    unread = F.col("_envelope.unread")
    valid = F.col("_envelope").isNotNull() & unread.isNull()
    return (
        df.withColumn("_envelope", envelope)
        .withColumn("parse_ok", valid | F.get_json_object(unread, "$").isNotNull())
        .withColumn("raw", F.coalesce(F.get_json_object(text, "$.data"), F.lit("{}")))
        .withColumn(_FIELDS, F.col("_envelope.data"))
        .drop("_envelope")
    )


def _member(key: str, kind: str) -> Column:
    return F.try_variant_get(F.col(_FIELDS)[key], "$", kind)


def validate_trades(df: DataFrame, reject_non_finite: bool = True) -> DataFrame:
    """Check and convert unwrapped trades.

    Adds the typed columns, ``missing_keys`` and ``reject_reason`` (null for a valid trade).
    ``m`` must be a JSON true or false. ``reject_non_finite=False`` lets NaN and infinite
    numbers through.
    """
    required = F.array(*map(F.lit, C.REQUIRED_KEYS))
    present = F.coalesce(F.map_keys(_FIELDS), F.array().cast("array<string>"))
    is_boolean = F.schema_of_variant(F.col(_FIELDS)["m"]) == "BOOLEAN"
    kept = [name for name in df.columns if name != _FIELDS]
    checked = {
        "missing_keys": F.array_except(required, present),
        "symbol": X.clean_symbol(_member("s", "string")),
        "price": _member("p", "double"),
        "quantity": _member("q", "double"),
        "timestamp_ms": _member("T", "bigint"),
        "trade_id": _member("t", "bigint"),
        "is_buyer_maker": F.when(is_boolean, _member("m", "boolean")),
    }
    typed = df.select(*kept, *[value.alias(name) for name, value in checked.items()])
    untyped = F.lit(False)
    for name in ("price", "quantity", "timestamp_ms", "trade_id", "is_buyer_maker"):
        untyped = untyped | F.col(name).isNull()
    infinite = ~(X.is_finite(F.col("price")) & X.is_finite(F.col("quantity")))
    too_low = (F.col("timestamp_ms") <= 0) | (F.col("price") <= 0) | (F.col("quantity") <= 0)
    reason = (
        F.when(~F.col("parse_ok"), C.BAD_JSON)
        .when(F.size("missing_keys") > 0, C.MISSING_FIELD)
        .when(untyped, C.BAD_TYPE)
        .when(F.coalesce(F.col("symbol"), F.lit("")) == "", C.EMPTY_SYMBOL)
    )
    if reject_non_finite:
        reason = reason.when(infinite, C.NON_FINITE)
    reason = reason.when(too_low, C.NON_POSITIVE)
    # A filter on these columns must not be pushed below and parse the text once more for each
    # column it names; it stops at a generator.
    row = F.struct(*checked, reason.alias("reject_reason"))
    return typed.select(*kept, F.inline(F.array(row)))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by ``reject_reason``."""
    accepted = df.filter(F.col("reject_reason").isNull()).drop("reject_reason", "missing_keys")
    return accepted, df.filter(F.col("reject_reason").isNotNull())


def reject_report(df: DataFrame) -> DataFrame:
    """Number of rows per reject reason."""
    return (
        df.filter(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason")
        .agg(F.count("*").alias("rejected"))
    )


def duplicate_count(valid: DataFrame, key: Sequence[str] = ("symbol", "trade_id")) -> DataFrame:
    """Duplicates per symbol by counting alone: copies of an id are merged before the shuffle."""
    copies = valid.groupBy(*key).agg((F.count("*") - 1).alias("_extra"))
    return copies.groupBy(key[0]).agg(F.sum("_extra").alias("duplicates"))


def enrich_trades(df: DataFrame, source: str = C.SOURCE_NAME) -> DataFrame:
    """Add value, ISO time and source, and project to the clean schema."""
    derived = {
        "trade_value_usdt": X.trade_value(F.col("price"), F.col("quantity")),
        "trade_time": X.iso_utc(F.col("timestamp_ms")),
        "source": F.lit(source),
    }
    return df.select(
        *[derived.get(f.name, F.col(f.name)).alias(f.name) for f in CLEAN_TRADE.fields]
    )


def to_records(df: DataFrame) -> DataFrame:
    """Clean trades as JSON text in ``value``, keyed by symbol, for a topic."""
    return df.select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct(*[f.name for f in CLEAN_TRADE.fields])).alias("value"),
    )
