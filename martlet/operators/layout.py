"""Clustered writes, and a report of how well files are separated by an expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.ordered import asc, running
from martlet.sizing import limit, segment_count, stored


def clustered(
    df: DataFrame, by: Sequence[Column], tie_break: Sequence[str], rows_per_file: int | None = None
) -> DataFrame:
    """Rows ordered into files by ``by``. The tie-break lets one value that holds a large part of the
    table spread over as many files as it needs."""
    files = segment_count(df.count(), rows_per_file or limit(df.sparkSession, "fileRows"))
    order = [*by, *[F.col(c) for c in tie_break]]
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


SAMPLES = 64  # rows of the hash sample for each cell of a column


def quantile_rank(df: DataFrame, by: Column, sample: Column, cells: int, rows: int) -> Column:
    """Number of the cell, 0 to ``cells - 1``, that ``by`` falls into; cells hold about equally many rows.

    Cuts come from a hash sample of bounded size, which decides where rows lie but drops none. A value that fills
    several cells has the number of the last one; NULL is in the first.
    """
    one_in = max(1, rows // (cells * SAMPLES))
    chosen = df.where(F.pmod(F.xxhash64(sample), F.lit(one_in)) == 0).select(by.alias("v")).where(F.col("v").isNotNull())
    values = chosen.agg(F.array_sort(F.collect_list("v"))).first()[0] or []
    cuts = [values[i * len(values) // cells] for i in range(1, cells)] if values else []
    if not cuts:
        return F.lit(0)

    def passed(low: int, high: int) -> Column:
        """Number of cuts up to ``by``, between ``low`` and ``high``, by halving."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.lit(cuts[middle]) <= by, passed(middle + 1, high)).otherwise(passed(low, middle))

    return F.when(by.isNull(), 0).otherwise(passed(0, len(cuts)))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """Bits of all ranks in turn, the highest first: near on this curve is near in each of them."""
    out = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")))
    return out


def clustered_curve(
    df: DataFrame, by: Sequence[Column], tie_break: Sequence[str], rows_per_file: int | None = None, bits: int = 6,
) -> DataFrame:
    """Rows ordered into files along a space-filling curve through quantile ranks of all of ``by``.

    In an order by (a, b) a filter on b alone meets every file; here it meets about the same part of the files as one
    on a. The tie-break spreads cells of any size over files.
    """
    rows = df.count()
    files = segment_count(rows, rows_per_file or limit(df.sparkSession, "fileRows"))
    key = F.struct(*tie_break)
    place = interleaved([quantile_rank(df, c, key, 1 << bits, rows) for c in by], bits)
    placed = df.withColumn("_place", place)
    order = ["_place", *tie_break]
    return placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_place")


def files_to_read(df: DataFrame, by: Column, low, high) -> int:
    """Files of a file-backed frame whose range of ``by`` meets [low, high]: those that statistics cannot rule out."""
    return file_ranges(df, by).where((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))).count()


def file_ranges(df: DataFrame, by: Column) -> DataFrame:
    """Smallest and largest value of ``by`` in every file of a file-backed frame."""
    return df.select(F.col("_metadata.file_path").alias("file"), by.alias("v")).groupBy("file").agg(
        F.min("v").alias("low"), F.max("v").alias("high")
    )


def overlap_report(ranges: DataFrame) -> DataFrame:
    """One row: how many files there are, and how much their ranges ``[low, high]`` overlap.

    ``average_overlaps`` is the mean number of other files whose range meets a file's range.
    ``average_depth`` is the mean number of files that hold a file's lowest value, itself included.
    Both come from one sweep over the range ends. A file meets all files except those that end
    before it begins and those that begin after it ends, so counts along the sorted ends suffice and
    no pair of files is ever formed.
    """
    known = ranges.where(F.col("low").isNotNull())
    ends = known.select(
        "file", "low", "high",
        F.explode(F.array(
            F.struct(F.col("low").alias("at"), F.lit(0).alias("side")),
            F.struct(F.col("high").alias("at"), F.lit(1).alias("side")),
        )).alias("end"),
    ).select("file", "low", "high", "end.at", "end.side")
    # At equal values beginnings (0) sort before ends (1): touching ranges overlap.
    per_value = ends.groupBy("at", "side").agg(F.count(F.lit(1)).alias("n"))
    swept = running(per_value, [], asc("at", "side"), {
        "begun": F.when(F.col("side") == 0, F.col("n")).otherwise(0),
        "ended": F.when(F.col("side") == 1, F.col("n")).otherwise(0),
    })
    lows = swept.where(F.col("side") == 0).select(F.col("at").alias("low"), "begun", "ended")
    highs = swept.where(F.col("side") == 1).select(
        F.col("at").alias("high"), F.col("begun").alias("begun_by_high"))
    per_file = known.join(lows, "low").join(highs, "high")
    # begun - ended at a low counts the files that cover it; files that begin later, up to the high
    # end, overlap as well.
    depth = F.col("begun") - F.col("ended")
    overlaps = F.col("begun_by_high") - F.col("ended") - 1
    return per_file.agg(
        F.count(F.lit(1)).alias("total_partition_count"),
        F.count_if(F.col("low") == F.col("high")).alias("total_constant_partition_count"),
        F.round(F.avg(overlaps), 4).alias("average_overlaps"),
        F.round(F.avg(depth), 4).alias("average_depth"),
    )


def clustering_report(df: DataFrame, by: Column) -> DataFrame:
    # Stored: a row for each file, so the sweep does not read the table again for each of its steps.
    return overlap_report(stored(file_ranges(df, by)))
