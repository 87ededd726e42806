"""Newline-delimited JSON files to RAW rows, with the three ways of treating bad lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.sizing import lookup_join, stored

ON_ERROR = ("continue", "abort", "skip_file")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines of the files at ``path`` with their file name and full path.

    One line is one row; an outer array is not taken apart.
    """
    return as_lines(spark.read.text(path))


def as_lines(text: DataFrame) -> DataFrame:
    """The same for a text frame that is already open, batch or streaming."""
    return text.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_name").alias("src_filename"),
        F.col("_metadata.file_path").alias("src_path"),
    ).where(F.trim("line") != "")


def is_bad(line: Column) -> Column:
    return F.try_parse_json(line).isNull()


def to_raw(lines: DataFrame, on_error: str = "abort", file_column: str = "src_path") -> DataFrame:
    """Parse ``line`` into the variant column ``raw``.

    ``continue`` drops bad lines, ``abort`` fails the job on the first one, ``skip_file`` drops every
    line of a file that has one. All other columns are kept.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    if on_error == "skip_file":
        lines = without_bad_files(lines, file_column)
    # The parse sits in a generator: a filter on its result would be pushed below it and parse every
    # line twice, and a plain column would not be parsed at all by a job that only counts rows.
    if on_error == "abort":
        parsed = F.array(F.parse_json("line"))
    else:
        parsed = F.array_compact(F.array(F.try_parse_json("line")))
    kept = [c for c in lines.columns if c != "line"]
    return lines.select(F.explode(parsed).alias("raw"), *kept)


def rejected(lines: DataFrame) -> DataFrame:
    """The lines ``continue`` would drop, for a quarantine table."""
    return lines.where(is_bad(F.col("line")))


def without_bad_files(lines: DataFrame, file_column: str = "src_path") -> DataFrame:
    """Lines of files in which every line parses. A line without a file stands for itself."""
    bad = rejected(lines.where(F.col(file_column).isNotNull())).select(file_column).distinct()
    # Stored, because counting and joining the list would otherwise parse every line twice more.
    return lookup_join(lines, stored(bad), file_column, "left_anti")


def read_json_events(
    spark: SparkSession, path: str | list[str], on_error: str = "continue"
) -> DataFrame:
    """RAW rows: ``raw``, ``src_filename`` and one ``loaded_at`` for the whole load."""
    return stamp(to_raw(read_lines(spark, path), on_error).drop("src_path"))


def stamp(rows: DataFrame) -> DataFrame:
    return rows.withColumn("loaded_at", F.localtimestamp())


def rows_per_file(raw: DataFrame) -> DataFrame:
    return raw.groupBy("src_filename").agg(F.count(F.lit(1)).alias("row_count"))
