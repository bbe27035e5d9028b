"""What the text operators share: words, the held-out fold, tables, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import durable, durable_dir  # noqa: F401  (re-exported)

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, text_col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


def held_out(id_column: Column) -> Column:
    """The fold that no model learns from; a null id is held out as well."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, inside one expression."""
    return F.transform(F.array(value), body)[0]


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[list]], schema: str) -> DataFrame:
    """``mapInArrow`` for functions from columns to columns, a bounded batch at a time.

    ``rows`` gets an iterator of dictionaries of Python lists and yields lists of columns in the
    order of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        columns = (
            {n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)}
            for batch in batches
            for part in slices(batch)
        )
        for out in rows(columns):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, arrow.types)], schema=arrow)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Short pieces of a batch, so that few texts are Python objects at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def with_key(df: DataFrame) -> DataFrame:
    """``df`` with its columns renamed to c0, c1, ... and ``key``, 128 bits of digests of the whole row. Rows without an id,
    or with the same one, are told apart by it, equal rows share it, and no name clashes. Nothing is stored."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    # Digests pass over nulls, so where they are is digested as well.
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in plain.columns])
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(seed), nulls, *plain.columns)), 16, "0") for seed in (1, 2)]
    return plain.withColumn("key", F.concat(*halves))


def bounded_sample(df: DataFrame, class_col: str, per_class: int, seed: int = 7) -> DataFrame:
    """``per_class`` distinct rows of each class, all where there are fewer, chosen by a hash of the whole row.

    Copies of a row count once, so neither a row with many copies nor their absence changes the bound. A null class is a class. Reruns
    give the same rows; an empty table gives none.

    The smallest hashes are taken. Only hashes that should be enough are gathered, more of them if copies or chance
    made them too few; the driver gets a size and the last hash for each class, and rows are read once more by their hash.
    """
    key = F.col(class_col)
    digest = F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns])
    sizes = {row[0]: row[1] for row in df.groupBy(key).agg(F.count("*")).collect()}
    spare, open_classes, kept = 2.0, list(sizes), F.lit(False)
    while open_classes:
        wanted, cuts = F.lit(False), {}
        for name in open_classes:
            cuts[name] = min((1 << 63) - 1, -(1 << 63) + int((1 << 64) * spare * per_class / sizes[name]))
            wanted = wanted | (key.eqNullSafe(F.lit(name)) & (digest <= F.lit(cuts[name])))
        near = df.where(wanted).select(key.alias("class"), digest.alias("digest")).distinct()
        order = F.row_number().over(Window.partitionBy("class").orderBy("digest"))
        near = near.withColumn("n", order).where(F.col("n") <= per_class)
        found = {r["class"]: r for r in near.groupBy("class").agg(F.count("*").alias("n"), F.max("digest").alias("last")).collect()}
        for name in list(open_classes):
            enough = name in found and found[name]["n"] == per_class
            if enough or cuts[name] == (1 << 63) - 1:
                last = found[name]["last"] if name in found else -(1 << 63)
                kept = kept | (key.eqNullSafe(F.lit(name)) & (digest <= F.lit(last)))
                open_classes.remove(name)
        spare *= 8
    rows = df.where(kept).withColumn("__digest", digest)
    return rows.groupBy(class_col, "__digest").agg(*[F.first(c).alias(c) for c in df.columns if c != class_col]).select(*df.columns)


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order_by: list[str], keep: list[str], rows_per_part: int = 1_000_000) -> DataFrame:
    """The columns ``keep`` of all rows and ``index``, the place of a row in the order over all rows, from 0.

    Rows are sorted over ranges and numbered in place; the ranges meet in one row of offsets each. Rows that are
    equal in ``order_by`` are cut as well, by a hash of their place in ``df``, so a hot key makes no large range.
    ``df`` is read to count, to sample and to sort.
    """
    salted = df.withColumn("__salt", F.xxhash64(F.monotonically_increasing_id()))
    parts = max(shuffle_parts(df), -(-df.count() // rows_per_part))
    order = [*order_by, "__salt"]
    row = F.monotonically_increasing_id()  # the partition in the upper 31 bits, the row in the lower 33
    stored = durable(
        salted.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("__row", row)
        .select(*keep, F.shiftright("__row", 33).alias("__part"), F.expr("__row & 8589934591").alias("__at"))
    )
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("__part").agg(F.count("*").alias("__n"))
    offsets = durable(sizes.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before")))
    return stored.join(offsets, "__part").select(*keep, (F.col("__before") + F.col("__at")).alias("index"))


def crc32_sql(number: str) -> str:
    """SQL for the unsigned CRC-32 of a number in decimal, bit by bit."""
    step = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    text = f"({number})::VARCHAR"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {step}), 4294967295)"
