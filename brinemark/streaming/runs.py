"""Stream sources, sinks and the incremental stages.

Every stage is append-only, reads what is available and stops; only the optional removal
of lines that are delivered again and the daily windows keep state. The file sink's commit log makes each stage exactly-once; downstream streams read
that log, so they never see files of an unfinished batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T, Window as W

from brinemark.operators import daily, parse, quality, seastate
from brinemark.session import stored
from brinemark.sources import schemas, tables


def read_lines_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """New text files of a folder, one row per line."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def with_provenance(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("value").alias("data"),
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("ingestion_timestamp"),
        # Stored with the line, so equal lines stay apart and later replays see the same.
        F.expr("uuid()").alias("line_id"),
    )


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New files of a table; ``max_files`` bounds a batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def write_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), timeout: float | None = None
) -> None:
    """Append what is available now and wait for the end.

    A stream that outlives ``timeout`` seconds is stopped and reported; its
    checkpoint lets the next run go on from there. Errors surface.
    """
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start()
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream to {path} did not finish in {timeout} s")


def run_stream(source: DataFrame, transform: Callable[[DataFrame], DataFrame], table: schemas.Table, base: str) -> None:
    """One source, one transformation, one declared table."""
    write_stream(transform(source), table.path(base), checkpoint_path(base, table), table.partition_by)
    schemas.recover_partitions(source.sparkSession, table)


def checkpoint_path(base: str, table: schemas.Table) -> str:
    return f"{base.rstrip('/')}/checkpoints/{table.layer}_{table.name}"


def ingest(spark: SparkSession, landing: str, base: str, max_files: int | None = None, once: str | None = None) -> None:
    """Landing text files to the table of lines; ``max_files`` bounds a batch.

    ``once`` (a duration) drops lines that are delivered again within that time in a file
    of another version: lines of the same file name up to its first dot, the same place
    and wording. Equal lines of one file stay apart. Lines are numbered in one stream and
    told apart in a second one, which remembers 16 bytes a line for that long, on disk.
    """
    if once is None:
        run_stream(read_lines_stream(spark, landing, max_files), with_provenance, schemas.BRONZE_LINES, base)
        return
    numbered = f"{base.rstrip('/')}/numbered_lines"
    number_lines(spark, landing, numbered, f"{checkpoint_path(base, schemas.BRONZE_LINES)}_numbered", max_files)
    with state_on_disk(spark):
        rows = read_table_stream(spark, numbered, NUMBERED_LINES, max_files)
        run_stream(rows, lambda df: first_delivery(df, once), schemas.BRONZE_LINES, base)
    # The second stream has taken them all and knows them by name; new ones get other names.
    folder = spark._jvm.org.apache.hadoop.fs.Path(numbered)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for batch in files.listStatus(folder):
        files.delete(batch.getPath(), True)


NUMBERED_LINES = T.StructType([
    T.StructField("data", T.StringType()), T.StructField("source_file", T.StringType()), T.StructField("place", T.LongType())])


def number_lines(spark: SparkSession, landing: str, path: str, checkpoint: str, max_files: int | None = None) -> None:
    """New lines with their place in their file; a file may be read in any number of splits.

    A batch holds whole files. Its lines are counted by split, then read again and
    numbered on from the splits before; a batch that is repeated replaces its folder.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(landing).select(
        F.regexp_replace("value", r"\r\z", "").alias("data"), F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split"))

    def write(batch: DataFrame, number: int) -> None:
        # Both passes read the same splits in the same tasks; lines of a split follow each other.
        at = batch.withColumn("row", F.monotonically_increasing_id())
        counted = at.groupBy("source_file", "split").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
        before = W.partitionBy("source_file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
        starts = stored(counted.select(
            "source_file", "split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")), "line-splits")
        placed = at.join(starts, ["source_file", "split"]).withColumn("place", F.col("row") + F.col("shift"))
        placed.select(*NUMBERED_LINES.fieldNames()).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # One bound for all the stores of an executor.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams started within keep their state in files beside the executor instead of on its heap."""
    before = {name: spark.conf.get(name, None) for name in STATE_ON_DISK}
    for name, value in STATE_ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def file_stem(path: str) -> Column:
    """A file's name up to its first dot, dots before it aside; a pattern would try every place of the path."""
    return F.substring_index(F.ltrim(F.substring_index(path, "/", -1), F.lit(".")), ".", 1)


def first_delivery(lines: DataFrame, within: str) -> DataFrame:
    """Numbered lines, without those delivered before (no longer than ``within`` ago)."""
    stem = file_stem("source_file")
    key = F.unhex(F.md5(F.concat_ws("\n", stem, F.col("place").cast("string"), "data")))
    rows = lines.select("data", "source_file", F.current_timestamp().alias("ingestion_timestamp"), key.alias("_key"))
    kept = rows.withWatermark("ingestion_timestamp", within).dropDuplicatesWithinWatermark(["_key"])
    return kept.select("data", "source_file", "ingestion_timestamp", F.expr("uuid()").alias("line_id"))


def silver_rows(lines: DataFrame, rules=quality.RULES, reference_trim: bool = False) -> DataFrame:
    clean, _ = quality.split_quality(parse.parse_lines(lines, reference_trim), rules)
    stamped = clean.withColumn("transformation_timestamp", F.current_timestamp())
    return stamped.select(*schemas.SILVER_METRICS.schema.fieldNames())


def rejected_rows(lines: DataFrame, rules=quality.RULES, reference_trim: bool = False) -> DataFrame:
    _, bad = quality.split_quality(parse.parse_lines(lines, reference_trim), rules)
    return quality.quarantine_rows(bad)


def refine(spark: SparkSession, base: str, rules=quality.RULES, reference_trim: bool = False,
           max_files: int | None = None) -> None:
    """Lines to clean observations and to quarantine, each with its own checkpoint.

    The two filters are complements, so a line reaches exactly one table. Lines
    are read twice; in exchange each sink stays exactly-once on its own and no
    batch has to be held between them.
    """
    for table, rows in ((schemas.SILVER_METRICS, silver_rows), (schemas.QUARANTINE, rejected_rows)):
        lines = read_table_stream(spark, schemas.BRONZE_LINES.path(base), schemas.BRONZE_LINES.schema, max_files)
        run_stream(lines, lambda df, rows=rows: rows(df, rules, reference_trim), table, base)


def classified_rows(metrics: DataFrame, model, cells: DataFrame | None = None, points: dict | None = None) -> DataFrame:
    scored = seastate.classify(metrics, model, cells=cells, points=points)
    return scored.select(
        "id", "coast_name", "datetime", "year", "wave_classification",
        F.current_timestamp().alias("classification_timestamp"))


def classify(spark: SparkSession, base: str, model, max_files: int | None = None) -> None:
    """Observations to sea states with a trained model.

    The forest is asked once for every cell between its thresholds that observations
    refined since the last run are in; a row of any other cell is scored by itself.
    """
    done = tables.read_or_empty(spark, schemas.SILVER_CLASSES.path(base), schemas.SILVER_CLASSES.schema).agg(
        F.max("classification_timestamp")).first()[0]
    rows = tables.read_or_empty(spark, schemas.SILVER_METRICS.path(base), schemas.SILVER_METRICS.schema)
    fresh = rows if done is None else rows.where(F.col("transformation_timestamp") > F.lit(done))
    points = seastate.split_points(model)
    cells = stored(seastate.cell_labels(fresh, model, points=points), "cell-labels")
    metrics = read_table_stream(spark, schemas.SILVER_METRICS.path(base), schemas.SILVER_METRICS.schema, max_files)
    run_stream(metrics, lambda df: classified_rows(df, model, cells, points), schemas.SILVER_CLASSES, base)


def daily_windows(metrics: DataFrame, delay: str) -> DataFrame:
    """Daily extremes of a stream; a day appears once when event time has passed its end by ``delay``."""
    days = daily.daily_summary(metrics.withWatermark("datetime", delay), windowed=True)
    return days.withColumn("year", F.year("date"))


def stream_daily(spark: SparkSession, base: str, delay: str = "2 days", max_files: int | None = None) -> None:
    """Observations to daily extremes by event-time windows.

    Each coast and day is written once and never again; rows that come more than
    ``delay`` behind the newest observation seen are dropped, so this suits feeds that
    arrive in order. State holds one row per coast and open day.
    """
    metrics = read_table_stream(spark, schemas.SILVER_METRICS.path(base), schemas.SILVER_METRICS.schema, max_files)
    run_stream(metrics, lambda df: daily_windows(df, delay), schemas.GOLD_DAILY_STREAM, base)
