"""Ordered work per key without sending a whole key to one task.

A window function over ``partitionBy(symbol)`` puts all rows of a symbol into one task. Here
the rows of a symbol are cut into consecutive blocks, and each block is given copies of the
few rows around it that its row frames reach (its halo). A window over (symbol, block) then
gives exactly the result of the window over the symbol.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import seconds
from ..session import durable

BLOCK = "_block"
PART = "_part"
POS = "_pos"
HALO = "_halo"


def time_block(timestamp: Column, width: str) -> Column:
    """Number of the time interval that a timestamp falls into."""
    return F.floor(F.unix_seconds(timestamp) / seconds(width))


def millis_block(timestamp_ms: Column, width: str) -> Column:
    return F.floor(timestamp_ms / (1000 * seconds(width)))


def total_order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """``order_by`` followed by every other column, so that no tie is left open; the columns that
    only render ``timestamp_ms`` are left out, so that they need not be computed to sort."""
    rendered = ("event_time", "trade_time") if "timestamp_ms" in df.columns else ()
    return [*order_by, *[c for c in df.columns if c not in order_by and c not in rendered]]


def range_parts(
    df: DataFrame,
    order_by: Sequence[str],
    parts: int | None = None,
    rows_per_part: int = 2_000_000,
) -> DataFrame:
    """Sort all rows over range partitions and number them: ``_part`` is the range, ``_pos``
    the place in it.

    Ranges are cut by row count over the whole order, so neither a hot symbol nor a hot minute
    makes a large part. Without ``parts`` the rows are counted first, so that parts keep their
    size when the data grows. The result is written out once, since the cuts come from a sample.
    Counting, sampling and sorting each read ``df``: hand over a stored table.
    """
    if parts is None:
        shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(shuffle, -(-df.count() // rows_per_part))
    row_id = F.monotonically_increasing_id()
    # The id carries the partition number in its upper 31 bits and the row in the lower 33.
    return durable(
        df.repartitionByRange(parts, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(POS, row_id)
        .withColumn(PART, F.shiftright(POS, 33))
        .withColumn(POS, F.col(POS).bitwiseAND(F.lit((1 << 33) - 1)))
    )


def part_offsets(parts: DataFrame, rows: Column | None = None, per: Sequence[str] = ()) -> DataFrame:
    """(``_part``, ``_offset``): how many rows, or how much of ``rows``, the parts before hold. One row per part, the only
    place where all parts meet. ``per`` counts for each value of these columns, for parts in which they alternate."""
    sizes = parts.groupBy(PART, *per).agg((F.count("*") if rows is None else F.sum(rows)).alias("_n"))
    ahead = Window.partitionBy(*per).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return durable(sizes.select(PART, *per, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset")))


def with_offsets(parts: DataFrame, offsets: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Parts with the ``_offset`` of :func:`part_offsets`, null values of ``per`` included."""
    if not per:
        return parts.join(offsets, PART)
    same = F.col(PART) == F.col("_at")
    for c in per:
        same = same & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    offsets = offsets.select(F.col(PART).alias("_at"), *[F.col(c).alias(f"_at_{c}") for c in per], "_offset")
    return parts.join(offsets, same).drop("_at", *[f"_at_{c}" for c in per])


def with_previous(parts: DataFrame, key: str, value: str, name: str, where: Column | None = None) -> DataFrame:
    """Rows of :func:`range_parts` ordered by ``key`` first, with the ``value`` of the row before it in the key, or of
    the nearest row before it that fulfils ``where``.

    A part looks at itself; only its last row is carried to the parts behind it.
    """
    where = F.lit(True) if where is None else where
    row = F.struct(F.col(key).alias("_key"), F.col(value).alias("_value"))
    ahead = (Window.unboundedPreceding, -1)
    # The place of the last row first, as numbers can be aggregated without sorting.
    tails = durable(parts.groupBy(PART).agg(F.max(F.when(where, F.col(POS))).alias(POS)))
    last = parts.filter(where).join(tails, [PART, POS]).select(PART, row.alias("_edge"))
    edge = F.last("_edge", ignorenulls=True).over(Window.orderBy(PART).rowsBetween(*ahead))
    edges = tails.select(PART).join(last, PART, "left").select(PART, edge.alias("_edge"))
    near = F.last(F.when(where, row), ignorenulls=True).over(Window.partitionBy(PART).orderBy(POS).rowsBetween(*ahead))
    rows = parts.withColumn("_near", near).join(durable(edges), PART, "left")
    rows = rows.withColumn("_near", F.coalesce("_near", "_edge"))
    same = F.col("_near._key").eqNullSafe(F.col(key)) & F.col("_near").isNotNull()
    return rows.withColumn(name, F.when(same, F.col("_near._value"))).drop("_near", "_edge")


def with_halo(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    values: Sequence[str],
    before: int = 0,
    after: int = 0,
    block: str = BLOCK,
) -> DataFrame:
    """``df`` plus, for each block, copies of the last ``before`` rows ahead of it and the first
    ``after`` rows behind it, marked by ``_halo``. Copies carry key, order and ``values`` only.

    Blocks must follow ``order_by`` within a key. Only the rows at block edges are exchanged
    between blocks: a map-side row limit keeps ``before`` (``after``) of them per task and block.
    """
    key, order_by = list(key), list(order_by)
    carried = [*order_by, *[c for c in values if c not in order_by]]
    types = dict(df.dtypes)
    result = df.withColumn(HALO, F.lit(False))
    # The block number first: Spark sorts by the bits of a leading number.
    group = [block, *key]
    for rows, step in ((before, -1), (after, 1)):
        if not rows:
            continue
        edge = [F.col(name).desc() if step < 0 else F.col(name) for name in order_by]
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*edge))
        edges = (
            df.select(*group, *carried)
            .withColumn("_rank", rank)
            .filter(F.col("_rank") <= rows)
            .groupBy(*group)
            .agg(F.sort_array(F.collect_list(F.struct(*carried))).alias("_rows"))
        )
        # A block may hold fewer rows than the frame reaches, so look over several blocks.
        around = Window.partitionBy(*key).orderBy(block)
        around = around.rowsBetween(-rows, -1) if step < 0 else around.rowsBetween(1, rows)
        near = edges.withColumn("_rows", F.flatten(F.collect_list("_rows").over(around)))
        start = F.greatest(F.size("_rows") - rows + 1, F.lit(1)) if step < 0 else F.lit(1)
        near = near.select(*group, F.explode(F.slice("_rows", start, F.lit(rows))).alias("_row"))
        known = {name: F.col(name) for name in group}
        known |= {name: F.col("_row")[name] for name in carried}
        result = result.union(
            near.select(
                *[known.get(c, F.lit(None).cast(types[c])).alias(c) for c in df.columns],
                F.lit(True).alias(HALO),
            )
        )
    return result
