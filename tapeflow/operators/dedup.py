"""De-duplication of trades and of window rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from . import blocks as B
from .spikes import ARRIVAL

# The number first: Spark sorts by the bits of a leading number, but compares texts row by row.
KEY = ("trade_id", "symbol")
_COPIES = 1024  # an id with more copies is cut into spans
_BUCKETS = 1 << 16


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence) -> DataFrame:
    """The first row of each key. Spark limits each group to one row per map task before the
    shuffle, so a group of many copies stays small."""
    order = [c for c in order_by if not (isinstance(c, str) and c in key)]
    first = Window.partitionBy(*key).orderBy(*(order or [F.lit(0)]))
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def dedup_recent(
    df: DataFrame, horizon: int | None = None, order_by: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Drop a trade whose id is among the last ``horizon`` accepted ids of its symbol;
    ``None`` remembers all ids. Ties in ``order_by`` are broken by the other columns."""
    if horizon is None:
        return keep_first(df, KEY, B.total_order(df, order_by))
    return mark_duplicates(df, horizon, order_by).filter(~F.col("is_duplicate")).drop("is_duplicate")


def mark_duplicates(
    df: DataFrame, horizon: int | None = None, order_by: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Like :func:`dedup_recent`, but keeps every row and adds ``is_duplicate``."""
    order = B.total_order(df, order_by)
    if horizon is not None:
        return place_duplicates(df, horizon, order).drop(B.PART, B.POS)
    hot = _hot_buckets(df)
    if not hot:
        return _mark_groups(df, order)
    is_hot = _bucket().isin(hot)
    return _mark_groups(df.filter(~is_hot), order).unionByName(_mark_hot_groups(df.filter(is_hot), order))


def _bucket():
    return F.pmod(F.xxhash64(*KEY), F.lit(_BUCKETS))


def _hot_buckets(df: DataFrame) -> list[int]:
    """The hash buckets of ids that hold far more rows than others. An id outside has fewer copies than the limit, so its
    copies may meet in one task."""
    sizes = durable(df.groupBy(_bucket().alias("_bucket")).agg(F.count("*").alias("_n")))
    limit = 8 * _COPIES + 2 * (sizes.agg(F.sum("_n")).first()[0] or 0) // _BUCKETS
    return [r[0] for r in sizes.filter(F.col("_n") > limit).select("_bucket").collect()]


def _mark_groups(df: DataFrame, order: Sequence[str]) -> DataFrame:
    copies = Window.partitionBy(*KEY).orderBy(*[c for c in order if c not in KEY] or [F.lit(0)])
    return df.withColumn("is_duplicate", F.row_number().over(copies) > 1)


def _mark_hot_groups(df: DataFrame, order: Sequence[str]) -> DataFrame:
    # All but the first copy of a map task are settled among themselves; only those firsts meet
    # in one group, so a group of copies never gathers in one task.
    task = Window.partitionBy(*KEY, "_task").orderBy(*order)
    split = df.withColumn("_task", F.spark_partition_id())
    split = split.withColumn("_first", F.row_number().over(task) == 1)
    split = split.withColumn("_group", F.when(F.col("_first"), -1).otherwise(F.col("_task")))
    whole = Window.partitionBy(*KEY, "_group").orderBy(*order)
    return (
        split.withColumn("_n", F.row_number().over(whole))
        .withColumn("is_duplicate", ~(F.col("_first") & (F.col("_n") == 1)))
        .drop("_task", "_first", "_group", "_n")
    )


def place_duplicates(df: DataFrame, horizon: int, order: Sequence[str]) -> DataFrame:
    """``df`` as :func:`blocks.range_parts` by symbol and ``order``, with ``is_duplicate``.

    Only copies of repeated ids are in question. A copy is dropped if fewer than ``horizon`` trades were
    accepted since the last accepted copy: its place less the duplicates before it says how many were.

    So the duplicates are a fixpoint: from the duplicates before each place follow those of each id,
    copy by copy, and from these the duplicates before each place. The decision on a row rests on earlier
    rows alone, so there is one fixpoint, and each round settles more rows from the front; two or three
    rounds do where ids return seldom.

    An id with many copies is cut into spans of places. A span takes what the spans before it accepted from
    the round before, so an id that is accepted again and again takes a round for each span at worst.
    """
    parts = B.range_parts(df, ["symbol", *[c for c in order if c != "symbol"]])
    places = parts.select(*KEY, B.PART, B.POS).join(B.part_offsets(parts), B.PART)
    places = places.select(*KEY, B.PART, B.POS, (F.col("_offset") + F.col(B.POS)).alias("_place"))
    return _mark(parts, _copies(places, horizon))


def duplicates_across(parts: DataFrame, horizon: int) -> DataFrame:
    """The same for rows that are in order already, as parts in which symbols alternate, with ``_part`` and ``_pos``: nothing
    is sorted over all rows, places are counted symbol by symbol."""
    inside = Window.partitionBy(B.PART, "symbol").orderBy(B.POS)
    placed = durable(parts.withColumn("_place", F.row_number().over(inside).cast("bigint")))
    places = B.with_offsets(placed.select(*KEY, B.PART, B.POS, "_place"), B.part_offsets(placed, per=["symbol"]), ["symbol"])
    places = places.select(*KEY, B.PART, B.POS, (F.col("_offset") + F.col("_place")).alias("_place"))
    return _mark(placed.drop("_place"), _copies(places, horizon, ["symbol"]))


def _mark(parts: DataFrame, copies: DataFrame) -> DataFrame:
    return (
        parts.join(copies, [B.PART, B.POS], "left")
        .withColumn("is_duplicate", F.coalesce("_copy", F.lit(False)))
        .drop("_copy")
    )


def _copies(places: DataFrame, horizon: int, per: Sequence[str] = ()) -> DataFrame:
    """Part and place of the duplicates. ``per`` tells that places and parts are those of a symbol."""
    counts = places.groupBy(*[F.col(c).alias(f"_{c}") for c in KEY]).agg(F.count("*").alias("_copies"))
    again = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY]
    span = max(_COPIES, min(16 * horizon, 64 * _COPIES))
    number = F.when(F.col("_copies") > _COPIES, F.floor(F.col("_place") / span)).otherwise(0)
    rows = places.join(counts.filter("_copies > 1"), again).select(
        *KEY, B.PART, B.POS, "_place", number.alias("_span"), F.lit(False).alias("_copy")
    )
    rows = durable(rows)
    while True:
        rows = durable(_decide(_with_duplicates_before(rows, per), horizon))
        if rows.filter(F.col("_copy") != F.col("_was")).isEmpty():
            break
        rows = rows.drop("_was")
    return rows.filter("_copy").select(B.PART, B.POS, "_copy")


def _with_duplicates_before(rows: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """``_free``: the place of a row less the duplicates among the rows before it."""
    copy = F.col("_copy").cast("bigint")
    inside = Window.partitionBy(B.PART, *per).orderBy(B.POS).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_offset") + F.coalesce(F.sum(copy).over(inside), F.lit(0))
    counted = B.with_offsets(rows, B.part_offsets(rows, copy, per), per)
    return counted.withColumn("_free", F.col("_place") - before).drop("_offset")


def _decide(rows: DataFrame, horizon: int) -> DataFrame:
    """``_copy`` anew for each row, copy by copy of an id, and the old one as ``_was``."""
    key = [*KEY, "_span"]
    row = F.struct("_place", "_free", B.PART, B.POS, "_copy")
    spans = rows.groupBy(*key).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    last = F.try_element_at(F.filter("_rows", lambda r: ~r["_copy"]), F.lit(-1))["_free"]
    earlier = Window.partitionBy(*KEY).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(last, ignorenulls=True)
    spans = spans.withColumn("_last", carried.over(earlier))

    def step(done, r):
        # Accepted places only are gathered: few, as a span is some horizons long.
        kept = done["last"].isNull() | (r["_free"] - done["last"] > horizon)
        return F.struct(
            F.when(kept, r["_free"]).otherwise(done["last"]).alias("last"),
            F.when(kept, F.array_append(done["kept"], r["_place"])).otherwise(done["kept"]).alias("kept"),
        )

    start = F.struct(F.col("_last").alias("last"), F.array().cast("array<bigint>").alias("kept"))
    decided = spans.withColumn("_kept", F.aggregate("_rows", start, step)["kept"])
    each = decided.select(*key, "_kept", F.inline("_rows"))
    return each.select(
        *KEY, B.PART, B.POS, "_place", "_span", (~F.array_contains("_kept", F.col("_place"))).alias("_copy"), F.col("_copy").alias("_was")
    )


def dedup_windows(df: DataFrame) -> DataFrame:
    """One row per (symbol, window_start): the larger trade count, then the later window end,
    then the other columns in order."""
    first = [F.col(c).desc() for c in ("trade_count", "window_end") if c in df.columns]
    rest = [c for c in df.columns if c not in ("symbol", "window_start", "trade_count", "window_end")]
    if not {"symbol", "window_start"} <= set(df.columns):
        return df
    return keep_first(df, ("window_start", "symbol"), first + rest)
