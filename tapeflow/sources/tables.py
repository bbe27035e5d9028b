"""Window tables on storage."""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..operators.dedup import dedup_windows
from ..schemas import SLIDING_TABLE, TUMBLING_TABLE

_IGNORE_LOG = "spark.sql.streaming.fileStreamSink.ignoreMetadata"
_DECLARED = {f.name: f for t in (SLIDING_TABLE, TUMBLING_TABLE) for f in t.fields}


@contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds any parquet file, at any depth. Stops at the first one."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return False
    files = fs.listFiles(target, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _as_declared(field: StructField, target: StructField) -> Column:
    column = F.col(field.name)
    if isinstance(target.dataType, TimestampType):
        if isinstance(field.dataType, LongType):
            return F.timestamp_micros((column / 1000).cast("bigint"))
        if isinstance(field.dataType, StringType):
            return F.try_to_timestamp(column)
        return column.cast("timestamp")
    return column.try_cast(target.dataType)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, folders, job) of the parquet files below a folder, none of them opened: the names of its partition folders,
    and what the files of one write share, the folder and the writer's mark in the name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    with _conf(spark, _IGNORE_LOG, "true"):
        files = files.option("pathGlobFilter", "*.parquet").load(path).where("length > 0")
    folders = F.array_join(F.regexp_extract_all("path", F.lit("([^/=]+)=[^/]*/"), F.lit(1)), ",")
    return files.select("path", folders.alias("folders"), F.regexp_replace("path", "/part-[0-9]+-", "/").alias("job"))


def _scans(spark: SparkSession, path: str) -> list[DataFrame]:
    """One scan for each kind of parquet files below a folder.

    Files may lack columns, hold them in other types or lie under partition folders. Spark merges the
    schemas of the files under like folders, reading footers in parallel tasks. Where the types of a column cannot be
    merged, one footer of each write is read, since the files of one write are alike, and writes of one schema
    share a scan. The driver gets the paths, as it does for any scan.
    """
    grouped = _listing(spark, path).groupBy("folders").agg(F.array_sort(F.collect_list(F.struct("path", "job"))).alias("files"))
    scans = []
    with _conf(spark, _IGNORE_LOG, "true"):
        reader = spark.read.option("basePath", path)
        for row in grouped.orderBy("folders").collect():
            try:
                scans.append(spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*[f.path for f in row.files]))
                continue
            except Exception as error:  # which exception it is depends on where Spark merges
                if "CANNOT_MERGE" not in str(error) and "Failed merging schema" not in str(error):
                    raise
            jobs: dict[str, list[str]] = {}
            for file in row.files:
                jobs.setdefault(file.job, []).append(file.path)
            alike: dict[str, list[str]] = {}
            for paths in jobs.values():
                alike.setdefault(reader.parquet(paths[0]).schema.json(), []).extend(paths)
            scans += [reader.parquet(*paths) for _, paths in sorted(alike.items())]
    return scans


def read_window_table(
    spark: SparkSession,
    *paths: str,
    schema: StructType = TUMBLING_TABLE,
    use_log: bool = False,
    dedup: bool = True,
    sort: bool = True,
) -> DataFrame:
    """Window table from one or more folders.

    All parquet files below a folder are read, whether or not the stream's sink log lists them;
    ``use_log=True`` reads what the log lists. Files are joined by column name: a column is null
    for the files that lack it. Columns are cast to the declared types, those of ``schema`` first;
    partition folders become columns. Folders without files give an empty table. Duplicates of
    (symbol, window_start) are dropped and rows are sorted by time, unless told otherwise.
    """
    declared = _DECLARED | {f.name: f for f in schema.fields}
    table = None
    for path in paths:
        if not use_log and not _exists(spark, path):
            continue
        if use_log:
            with _conf(spark, _IGNORE_LOG, "false"):
                scans = [spark.read.parquet(path)]
        else:
            scans = _scans(spark, path)
        for scan in scans:
            columns = [
                _as_declared(f, declared[f.name]).alias(f.name) if f.name in declared else f.name
                for f in scan.schema.fields
            ]
            frame = scan.select(*columns)
            table = frame if table is None else table.unionByName(frame, allowMissingColumns=True)
    if table is None:
        return spark.createDataFrame([], schema)
    if dedup:
        table = dedup_windows(table)
    order = [c for c in ("window_start", "symbol") if c in table.columns]
    return table.orderBy(*order) if sort and order else table


def preview(spark: SparkSession, path: str, rows: int = 10) -> DataFrame | None:
    """Print schema and the first rows of a table in time order, as they are stored, whether or not its sink log is
    complete; a message where there is none yet."""
    if not _exists(spark, path):
        print(f"No parquet files in {path} yet.")
        return None
    table = read_window_table(spark, path, dedup=False, sort=False)
    # Sorted for a few rows only: every task keeps its first ones.
    head = table.orderBy(*[c for c in ("window_start", "symbol") if c in table.columns]).limit(rows)
    table.printSchema()
    head.show(truncate=False)
    return head
