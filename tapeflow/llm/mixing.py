"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order. A document's virtual finish time is
the number of words its source has sent when the document is done, divided by the target of the
source. One global order by finish time, cut at the budget, gives each source its share.

The running sums need no group in one task: the shuffle order is a hash, so a source is cut into
buckets of equal hash ranges, each summed alone, and a bucket's offset is the sum of the buckets
before it. The global order is cut the same way into bins of finish time; only the bin in which
the budget ends is put in order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, durable, text_of, with_key

HASH_BITS = 60


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5, 2, 1)  # repeated over the sources in order
    share: float = 1.5  # the budget, as a share of all words
    passes: int = 2  # how often a document may be taken
    seed: int = 11


def shuffled(mix: Mix, id_column: Column) -> Column:
    """Place of a document in its queue: 60 bits of a digest of seed and id."""
    text = F.concat(F.lit(f"{mix.seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources in code-point order, null last, take the weights in turn. The budget is shared by
    weight; a target stops at ``passes`` times the source's size and what is over is shared again.
    In the order of (limit / weight), a source is at its limit if the level that the sources from
    it on would reach is not below its own limit. The windows run over one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]), (rank % len(mix.weights) + 1).cast("int"))
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    upward = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    return (
        totals.withColumns({"weight": weight, "limit": F.col("source_size") * float(mix.passes)})
        .withColumns(
            {
                "before": F.sum("limit").over(upward.rowsBetween(Window.unboundedPreceding, 0)) - F.col("limit"),
                "left": F.sum("weight").over(upward.rowsBetween(0, Window.unboundedFollowing)),
                "budget": F.sum("source_size").over(every) * F.lit(mix.share),
            }
        )
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("left"))
        .withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
        .withColumn("open_level", F.max(F.when(~F.col("full"), F.col("level"))).over(every))
        .select(
            "source",
            "source_size",
            F.when(F.col("full"), F.col("limit")).otherwise(F.col("open_level") * F.col("weight")).alias("target"),
        )
    )


def mix_sources(
    docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key_col: str | None = None
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, takes, and ``key_col`` if there is one, by which rows
    of one id are put in order.

    ``takes`` is how often the mix takes the document, 0 to ``passes``. A null text has size 0; documents
    of size 0 are never taken. Null is a source like any other. Rows with one id are separate documents, which
    share a place in the queue. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    sizes = durable(
        docs.select(
            docs[id_col].alias("id"),
            docs[source_col].cast("string").alias("source"),
            F.regexp_count(text_of(docs, text_col), F.lit(WORD)).cast("long").alias("size"),
            shuffled(mix, docs[id_col]).alias("place"),
            (docs[key_col] if key_col else F.lit(None).cast("string")).alias("key"),
        )
    )
    rows = sizes.count()
    targets = durable(source_targets(sizes, mix))
    # Buckets only split the work; enough of them to spread a hot source over all tasks.
    least = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 4096)
    bits = min(HASH_BITS, max(1, least).bit_length())
    sizes = sizes.withColumn("bucket", F.shiftright("place", HASH_BITS - bits))
    in_order = Window.partitionBy("source").orderBy("bucket")
    offsets = (
        sizes.groupBy("source", "bucket")
        .agg(F.sum("size").alias("words"))
        .withColumn("offset", F.sum("words").over(in_order) - F.col("words"))
        .select(F.col("source").alias("of"), F.col("bucket").alias("at"), "offset")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("place", "id", "size", "key").rowsBetween(Window.unboundedPreceding, 0)
    queues = sizes.withColumn("sent", F.sum("size").over(inside))
    queues = queues.join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at")), "left")
    totals = targets.withColumnRenamed("source", "from")
    queues = durable(
        queues.join(totals, F.col("source").eqNullSafe(F.col("from")), "left").select(
            "id", "source", "size", "place", "key", "source_size", "target", (F.col("sent") + F.col("offset")).alias("sent")
        )
    )
    finish = [(F.col("sent") + F.col("source_size") * p) / F.col("target") for p in range(mix.passes)]
    budget = targets.agg(F.sum("source_size") * F.lit(mix.share)).first()[0]
    cut = _cut(queues, finish, budget or 0.0, bins=max(1024, rows // 1024))
    takes = sum((F.when(_not_after(f, cut), 1).otherwise(0) for f in finish), F.lit(0)) if cut else F.lit(0)
    return queues.select(
        *([F.col("key").alias(key_col)] if key_col else []),
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, takes).otherwise(0).alias("takes"),
    )


def mixed(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """As many rows of each document as the mix takes, with all its columns.

    Rows with a null id, or with one id, are documents of their own; among equal rows it does not matter which is taken. A
    text without words is never taken. Columns may have any names. An empty table gives an empty result.
    """
    rows = with_key(docs)
    names = dict(zip(docs.columns, rows.columns))
    mix_of = mix_sources(rows, mix, names[id_col], names[text_col], names[source_col], "key")
    takes = mix_of.groupBy("key").agg(F.sum("takes").alias("takes"), F.count("*").alias("rows")).where("takes > 0")
    once = durable(takes.where("rows = 1").select("key", "takes"))
    # What equal rows are taken together is shared among them.
    often = durable(takes.where("rows > 1"))
    number = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    more = F.when(number <= F.col("takes") % F.col("rows"), 1).otherwise(0)
    share = F.floor(F.col("takes") / F.col("rows")) + more
    equal = rows.join(often, "key").withColumn("takes", share).where("takes > 0").select(*rows.columns, "takes")
    taken = rows.join(once, "key").select(*rows.columns, "takes").union(equal)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("takes"))).alias("take")
    return taken.select(*names.values(), copies).drop("take").toDF(*docs.columns)


def _cut(queues: DataFrame, finish: list[Column], budget: float, bins: int):
    """The last (finish, place, id) that the budget takes, or None."""
    sent = queues.where("size > 0").select("id", "place", "size", F.explode(F.array(*finish)).alias("finish"))
    sent = sent.withColumn("bin", F.floor(F.col("finish") * bins))
    by_bin = sent.groupBy("bin").agg(F.sum("size").alias("words"))
    filled = by_bin.withColumn("upto", F.sum("words").over(Window.orderBy("bin")))
    end = filled.where(F.col("upto") > budget).orderBy("bin").first()
    if end is None:  # the budget takes all
        last = sent.agg(F.max(F.struct("finish", "place", "id")).alias("last"))
    else:
        order = Window.orderBy("finish", "place", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
        here = sent.where(F.col("bin") == end["bin"]).withColumn("upto", F.sum("size").over(order))
        fits = here.where(F.col("upto") <= budget - (end["upto"] - end["words"]))
        last = fits.unionByName(sent.where(F.col("bin") < end["bin"]).withColumn("upto", F.lit(0).cast("long"))).agg(
            F.max(F.struct("finish", "place", "id")).alias("last")
        )
    return last.first()["last"]


def _not_after(finish: Column, cut) -> Column:
    key = F.struct(finish.alias("finish"), F.col("place"), F.col("id"))
    return key <= F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["place"]).alias("place"), F.lit(cut["id"]).alias("id"))


#: The same mix in SQL, over a table ``documents``.
SQL = """
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5('11:' || doc_id), 1, 15))::BIGINT AS place
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank
  FROM sizes GROUP BY source),
limits AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS most FROM totals),
levels AS (
  SELECT *, ((SELECT sum(source_size)::DOUBLE * 1.5::DOUBLE FROM totals)
             - (sum(most) OVER (ORDER BY most / weight, source IS NULL, source ROWS UNBOUNDED PRECEDING) - most))
            / sum(weight) OVER (ORDER BY most / weight, source IS NULL, source
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM limits),
targets AS (
  SELECT source, source_size,
         CASE WHEN most <= level * weight THEN most
              ELSE (SELECT max(level) FROM levels WHERE most > level * weight) * weight END AS target
  FROM levels),
queues AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS sent
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
sends AS (
  SELECT doc_id, place, size, (sent + source_size * pass)::DOUBLE / target AS finish
  FROM queues, (VALUES (0), (1)) AS p(pass) WHERE size > 0),
filled AS (
  SELECT doc_id, sum(size) OVER (ORDER BY finish, place, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM sends),
taken AS (
  SELECT doc_id, count(*) AS takes FROM filled
  WHERE upto <= (SELECT sum(source_size)::DOUBLE * 1.5::DOUBLE FROM totals) GROUP BY doc_id)
SELECT q.doc_id, q.size::BIGINT AS size, q.source_size, q.target, (q.size * coalesce(t.takes, 0))::BIGINT AS taken
FROM queues q LEFT JOIN taken t USING (doc_id)
"""
