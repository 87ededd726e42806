"""What the operators share: stored intermediate tables, row identities, bytes from text columns."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.session import setting, shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITTEN: dict[str, SparkSession] = {}


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store that this application wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _WRITTEN.pop(folder, None)


def _remove_all() -> None:
    for folder, spark in list(_WRITTEN.items()):
        try:
            remove(spark, folder)
        except Exception:  # the session is gone; the folder belongs to the ended application
            _WRITTEN.pop(folder, None)


atexit.register(_remove_all)


def stored(df: DataFrame, *sort: str) -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it back.

    Later jobs then depend on files that every executor sees, not on an executor's memory or local
    disk, and the shuffle files of the job that made them are dropped as soon as it ends. The folder
    goes when the application ends, or earlier by :func:`drop`.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    _WRITTEN[folder] = spark
    with setting(spark, _CLEANUP, "true"):
        rows = df.sortWithinPartitions(*sort) if sort else df
        rows.write.option("compression", "zstd").parquet(folder)
    kept = spark.read.schema(df.schema).parquet(folder)
    kept._stored_in = folder
    return kept


def drop(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that no later job reads."""
    for table in tables:
        remove(table.sparkSession, table._stored_in)


def numbered(df: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` with a stored row number ``row``, so that repeated or null ids stay apart.

    The number is fixed by the write: a task that runs again later reads the same numbers.
    """
    return stored(df.select(F.monotonically_increasing_id().alias("row"), *columns))


def spread(df: DataFrame) -> DataFrame:
    """Enough tasks for work that is heavy per row, where a small input has few splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def column(name: str) -> Column:
    """A column by its name, whatever signs it holds."""
    return F.col("`{}`".format(name.replace("`", "``")))


def with_columns_mapped(df: DataFrame, run: Callable, added: list[T.StructField]) -> DataFrame:
    """``df`` through ``mapInArrow`` with ``added`` columns in place of any of the same name.

    ``run(names, at)`` makes the function of batches: ``names`` are those of its result, the kept columns first,
    and ``at`` gives the place of a kept column. Inside, columns have plain names, so any name is allowed outside.
    """
    kept = [c for c in df.columns if c not in {f.name for f in added}]
    rows = df.select(*[column(c) for c in kept])
    fields = [*rows.schema.fields, *added]
    plain = [f"c{i}" for i in range(len(fields))]
    schema = T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(plain, fields)])
    return rows.toDF(*plain[:len(kept)]).mapInArrow(run(plain, kept.index), schema).toDF(*[f.name for f in fields])
