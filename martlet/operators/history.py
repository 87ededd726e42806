"""Upsert log on plain parquet: merge, delete, past states, compaction and change feeds.

The table is an append-only log partitioned by batch. Each row is an upsert (``U``) or a delete
(``D``) of one key; a batch holds at most one row per key. The state at any point is the latest row
per key up to there, minus deleted keys. A replayed batch overwrites its own partition, so writing
it twice changes nothing. ``fold`` stores the state of the older batches as a base, published by one
rename; ``read_folded`` reads the newest base and the batches after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.session import setting
from martlet.sizing import tasks_for

OP, BATCH, COMMIT, INSERTED = "_op", "_batch_id", "commit_ts", "inserted_at"
LOG_COLUMNS = (OP, BATCH, COMMIT, INSERTED)
UPSERT, DELETE = "U", "D"


def log_rows(
    rows: DataFrame, batch_id: int | Column, commit_ts: Column, op: str | Column = UPSERT
) -> DataFrame:
    """Rows as they are stored in the log. ``rows`` must hold one row per key."""
    as_column = lambda v, t: v if isinstance(v, Column) else F.lit(v).cast(t)
    return rows.withColumns({
        OP: as_column(op, "string"),
        BATCH: as_column(batch_id, "bigint").cast("bigint"),
        COMMIT: commit_ts.cast("timestamp_ntz"),
        INSERTED: F.lit(None).cast("timestamp_ntz"),
    })


OPEN_FILES = 16  # a task that finds more batches in its rows sorts the rest of them


def append_batch(rows: DataFrame, path: str) -> None:
    """Write the batches in ``rows``; a batch that is already there is replaced.

    A task writes several batches at a time, so that it need not sort its rows by batch first.
    """
    with setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
            .partitionBy(BATCH).parquet(path)
        )


def read_log(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _beside(right: DataFrame, key: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with its key renamed, and the condition that keys are equal, NULL equal to NULL."""
    on = F.lit(True)
    for i, name in enumerate(key):
        right = right.withColumnRenamed(name, f"_other_{i}")
        on = on & F.col(name).eqNullSafe(F.col(f"_other_{i}"))
    return right, on


def current_state(log: DataFrame, key: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Latest row per key that is not deleted, with the time the key was (last) inserted.

    The rows are shuffled and sorted by key once, whatever the number of deleted keys; a key has at most one row for
    each batch. ``tasks`` divides the shuffle (see ``sizing.tasks_for``); without it the session's number of partitions does.
    """
    payload = [c for c in log.columns if c not in key and c not in LOG_COLUMNS]
    upsert = F.col(OP) == UPSERT
    versions = log.where(F.col(OP).isin(UPSERT, DELETE)).select(
        *key, BATCH, upsert.alias("_upsert"), F.coalesce(INSERTED, COMMIT).alias(INSERTED),
        *[F.when(upsert, F.col(c)).alias(c) for c in payload])
    if tasks is not None:
        versions = versions.repartition(tasks, *key)
    deleted_in = F.max(F.when(~F.col("_upsert"), F.col(BATCH))).over(Window.partitionBy(*key))
    alive = versions.withColumn("_deleted_in", deleted_in).where(
        F.col("_upsert") & (F.col("_deleted_in").isNull() | (F.col(BATCH) > F.col("_deleted_in")))
    )
    return alive.groupBy(*key).agg(
        F.max_by(F.struct(*payload), BATCH).alias("_row"), F.min(INSERTED).alias(INSERTED),
    ).select(*key, "_row.*", INSERTED).select(
        *[c for c in log.columns if c not in LOG_COLUMNS], INSERTED
    )


def as_of(log: DataFrame, key: Sequence[str], moment: Column) -> DataFrame:
    """State at ``moment``, including what was committed exactly then."""
    log = log.where(F.col(COMMIT) <= moment)
    return current_state(log, key, tasks_for(log))


def as_of_offset(log: DataFrame, key: Sequence[str], now: Column, seconds: int) -> DataFrame:
    """State ``seconds`` before ``now``."""
    return as_of(log, key, F.timestamp_add("SECOND", F.lit(-seconds), now))


def before_batch(log: DataFrame, key: Sequence[str], batch_id: int) -> DataFrame:
    log = log.where(F.col(BATCH) < batch_id)
    return current_state(log, key, tasks_for(log))


def compact(log: DataFrame, key: Sequence[str], keep_after: Column) -> DataFrame:
    """The same log with everything up to ``keep_after`` folded into one base row per live key.

    States from ``keep_after`` on are unchanged; earlier ones are given up.
    """
    old = log.where(F.col(COMMIT) <= keep_after)
    last = old.agg(F.max(BATCH)).scalar()
    base = current_state(old, key, tasks_for(old)).withColumns({
        OP: F.lit(UPSERT), BATCH: last, COMMIT: keep_after.cast("timestamp_ntz"),
    })
    return base.select(*log.columns).unionByName(log.where(F.col(COMMIT) > keep_after))


def _listed(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the sub-folders ``prefix`` N."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(path)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def _bases(log_path: str) -> str:
    return f"{log_path.rstrip('/')}_bases"


def newest_base(spark: SparkSession, log_path: str) -> int | None:
    """Last batch that the newest published base holds."""
    return max(_listed(spark, _bases(log_path), "upto="), default=None)


def open_batches(spark: SparkSession, log_path: str) -> list[int]:
    """Batches of the log that no base holds yet."""
    base = newest_base(spark, log_path)
    return [n for n in _listed(spark, log_path, f"{BATCH}=") if base is None or n > base]


def read_folded(spark: SparkSession, log_path: str, schema) -> DataFrame:
    """The newest base and the batches after it: for the current state the same as the whole log."""
    base = newest_base(spark, log_path)
    if base is None:
        return read_log(spark, log_path, schema)
    rows = spark.read.schema(schema).parquet(f"{_bases(log_path)}/upto={base}")
    if not open_batches(spark, log_path):
        return rows
    return rows.unionByName(read_log(spark, log_path, schema).where(F.col(BATCH) > base))


def fold(spark: SparkSession, log_path: str, key: Sequence[str], schema) -> int | None:
    """Store base and open batches as a new base; returns its last batch, or None if nothing is open.

    The base is written aside and moved to its place whole, so a reader sees the old one or the new
    one, and a job that dies leaves a folder nobody reads. The log keeps its batches until ``expire``.
    """
    batches = open_batches(spark, log_path)
    if not batches:
        return None
    last, log = batches[-1], read_folded(spark, log_path, schema)
    when = log.agg(F.max(COMMIT)).first()[0]
    rows = current_state(log, key, tasks_for(log)).withColumns({
        OP: F.lit(UPSERT), BATCH: F.lit(last).cast("bigint"), COMMIT: F.lit(when).cast("timestamp_ntz")})
    aside = f"{_bases(log_path)}/aside-{uuid.uuid4().hex}"
    rows.select(*log.columns).write.parquet(aside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.rename(path(aside), path(f"{_bases(log_path)}/upto={last}")):
        raise RuntimeError(f"the base of batch {last} could not be published")
    return last


def expire(spark: SparkSession, log_path: str) -> list[int]:
    """Delete what the newest base replaces: older bases and the batches it holds. Past states before it
    are given up. Call it when no reader of the older files is left."""
    base = newest_base(spark, log_path)
    if base is None:
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(log_path).getFileSystem(spark._jsc.hadoopConfiguration())
    for older in _listed(spark, _bases(log_path), "upto="):
        if older < base:
            system.delete(path(f"{_bases(log_path)}/upto={older}"), True)
    held = [n for n in _listed(spark, log_path, f"{BATCH}=") if n <= base]
    for batch in held:
        system.delete(path(f"{log_path}/{BATCH}={batch}"), True)
    return held


def only_new(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key ``target`` lacks: a merge that inserts but never updates."""
    other, same = _beside(target.select(*key), key)
    return source.join(other, same, "left_anti")


def update_rows(state: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """New versions of the rows that match, for the next batch of the log.

    All new values are computed from the old row, as UPDATE does.
    """
    matching = state.where(condition).drop(INSERTED)
    return matching.select(*[
        changes[c].alias(c) if c in changes else F.col(c) for c in matching.columns
    ])


def delete_rows(state: DataFrame, condition: Column) -> DataFrame:
    return state.where(condition).drop(INSERTED)


def change_feed(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """What turns ``old`` into ``new``: rows with ``_action`` and ``_is_update``.

    An update is a DELETE of the old row and an INSERT of the new one, both flagged. ``key`` must be
    unique in both tables, so the full join has at most one partner per row.
    """
    values = list(old.columns)
    before = old.select(*key, F.struct(*values).alias("_before"))
    after, same = _beside(new.select(*key, F.struct(*values).alias("_after")), key)
    both = before.join(after, same, "full").where(
        ~F.col("_before").eqNullSafe(F.col("_after"))
    )
    is_update = F.col("_before").isNotNull() & F.col("_after").isNotNull()
    changes = F.array_compact(F.array(
        F.when(F.col("_before").isNotNull(),
               F.struct(F.lit("DELETE").alias("action"), F.col("_before").alias("row"))),
        F.when(F.col("_after").isNotNull(),
               F.struct(F.lit("INSERT").alias("action"), F.col("_after").alias("row"))),
    ))
    return both.select(is_update.alias("_is_update"), F.explode(changes).alias("_change")).select(
        "_change.row.*", F.col("_change.action").alias("_action"), "_is_update"
    )


def inserts(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("_action") == "INSERT")


def apply_feed(old: DataFrame, feed: DataFrame, key: Sequence[str]) -> DataFrame:
    """The table after the feed: the inverse of ``change_feed``."""
    touched, same = _beside(feed.select(*key).distinct(), key)
    return old.join(touched, same, "left_anti").unionByName(
        inserts(feed).drop("_action", "_is_update")
    )


def has_data(feed: DataFrame) -> bool:
    """Whether there is anything to process, without counting it."""
    return not feed.isEmpty()
