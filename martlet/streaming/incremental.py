"""Incremental loading and merging with Structured Streaming.

Each step is a streaming query that processes what is new and stops (``availableNow``), or keeps
running when a processing interval is given. The checkpoint is the read position: it moves only
after a micro-batch has been written, and a batch that is replayed finds its own partition and leaves it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators import history
from martlet.operators.keyed import KeyedTable
from martlet.operators.maintained import MaintainedAggregate
from martlet.plans import mart
from martlet.sources import ingest

RAW_SCHEMA = T.StructType([
    T.StructField("raw", T.VariantType()),
    T.StructField("src_filename", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])
LOAD_BATCH = "_load_id"
# A file is new if it has not been loaded, however old it is: the source's default would leave out files
# more than a week older than the newest one seen.
ANY_AGE = {"maxFileAge": "36500d"}


def _trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def has_batch(spark: SparkSession, path: str, column: str, batch_id: int) -> bool:
    """Whether a batch is already in a table.

    A partition is moved to its place whole when its job commits, so one that is there is complete.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={batch_id}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _write_batch(rows: DataFrame, path: str, column: str, batch_id: int) -> None:
    """Write one batch as its own partition.

    A batch that is there from an earlier try is left as it is: readers that have taken its files would
    take rewritten ones again, and its load time would move.
    """
    if has_batch(rows.sparkSession, path, column, batch_id):
        return
    rows.withColumn(column, F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def start_load(
    spark: SparkSession, landing: str, raw_path: str, checkpoint: str,
    on_error: str = "continue", interval: str | None = None, files_per_batch: int | None = None,
):
    """Load new files of ``landing`` into RAW; files already loaded are skipped.

    A file is never split over micro-batches, so the verdict of ``skip_file`` is final.
    """
    reader = spark.readStream.options(**ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = ingest.as_lines(reader.text(landing))

    def write(batch: DataFrame, batch_id: int) -> None:
        raw = ingest.to_raw(batch, on_error).drop("src_path")
        _write_batch(ingest.stamp(raw), raw_path, LOAD_BATCH, batch_id)

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        **_trigger(interval)).start()


def reload_files(spark: SparkSession, files: str | list[str], raw_path: str) -> None:
    """Load files once more, past the checkpoint. The copies get a partition of their own."""
    again = ingest.read_json_events(spark, files)
    try:
        last = spark.read.parquet(raw_path).agg(F.min(LOAD_BATCH)).first()[0]
    except AnalysisException:  # nothing has been loaded so far
        last = None
    # Forced loads count downward from -1, so they never meet the number of a streamed batch.
    _write_batch(again, raw_path, LOAD_BATCH, min(last or 0, 0) - 1)


def read_raw_stream(
    spark: SparkSession, raw_path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Rows appended to RAW since the last successful read of the query that uses this."""
    stored = T.StructType([*RAW_SCHEMA.fields, T.StructField(LOAD_BATCH, T.LongType())])
    reader = spark.readStream.schema(stored).options(**ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(raw_path).drop(LOAD_BATCH)


def merge_purchase_events(batch: DataFrame, log_path: str, batch_id: int, commit_ts: Column) -> None:
    """Flatten RAW rows, keep one row per fact key, and write them as one batch of the fact log."""
    source = mart.fact_purchase_events(mart.stg_event_items(batch))
    history.append_batch(history.log_rows(source, batch_id, commit_ts), log_path)


def start_merge(
    spark: SparkSession, raw_path: str, log_path: str, checkpoint: str,
    interval: str | None = None, files_per_batch: int | None = None,
    merge: Callable[[DataFrame, str, int, Column], None] = merge_purchase_events,
):
    """Merge new RAW rows into the fact log. A batch that is delivered again keeps its commit time."""
    def write(batch: DataFrame, batch_id: int) -> None:
        base = history.newest_base(spark, log_path)
        if has_batch(spark, log_path, history.BATCH, batch_id) or (base is not None and batch_id <= base):
            return
        merge(batch, log_path, batch_id, F.localtimestamp())

    return read_raw_stream(spark, raw_path, files_per_batch).writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()


def start_followed_merge(
    spark: SparkSession, raw_path: str, table: KeyedTable, followers: Sequence[MaintainedAggregate], checkpoint: str,
    interval: str | None = "1 minute", files_per_batch: int | None = None,
):
    """Merge new RAW rows into a keyed fact and bring the aggregates that follow it up to date, within ``interval``.

    A batch that is delivered again finds itself merged; aggregates that an interrupted batch left behind catch up.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        own, now = batch.sparkSession, F.localtimestamp()
        source = mart.fact_purchase_events(mart.stg_event_items(batch))
        table.on(own).merge(batch_id, source, None, now)
        for follower in followers:
            follower.on(own).refresh(now)

    return read_raw_stream(spark, raw_path, files_per_batch).writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()


def start_dynamic_table(
    spark: SparkSession, raw_path: str, table_path: str, checkpoint: str,
    interval: str | None = "1 minute",
):
    """The continuously refreshed staging table: new RAW rows appear within ``interval``."""
    staged = mart.dyn_stg_events(read_raw_stream(spark, raw_path))
    return staged.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint).option("path", table_path).trigger(
        **_trigger(interval)).start()
