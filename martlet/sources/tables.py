"""Table lifecycle on parquet tables, including the steps Spark refuses to do in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlet.sizing import stored


def create_table(
    spark: SparkSession, name: str, columns: str, location: str | None = None
) -> None:
    """CREATE TABLE from a column list; NOT NULL and DEFAULT are allowed in it."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{where}")


def replace_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """CREATE OR REPLACE TABLE AS SELECT; also how a query result is saved as a table."""
    writer = df.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def insert_select(df: DataFrame, name: str) -> None:
    """INSERT INTO ... SELECT: columns go by position, as in SQL."""
    df.write.insertInto(name)


def add_column(spark: SparkSession, name: str, column: str) -> None:
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({column})")


def drop_column(spark: SparkSession, name: str, column: str) -> None:
    _rewrite(spark, name, spark.table(name).drop(column))


def rename_column(spark: SparkSession, name: str, old: str, new: str) -> None:
    _rewrite(spark, name, spark.table(name).withColumnRenamed(old, new))


def _rewrite(spark: SparkSession, name: str, changed: DataFrame) -> None:
    """Write the changed rows to a new table, then let it take the name of the old one."""
    copy = f"{name}__rewritten"
    spark.sql(f"DROP TABLE IF EXISTS {copy}")
    changed.write.format("parquet").saveAsTable(copy)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {copy} RENAME TO {name}")


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_view(spark: SparkSession, name: str, select: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def temporary_table(df: DataFrame, name: str) -> DataFrame:
    """A frame computed once and visible to this session's SQL under ``name``.

    Its rows are in the shared folder, so they outlive an executor; Spark removes them when nothing
    refers to them any more, if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    kept = stored(df)
    kept.createOrReplaceTempView(name)
    return kept
