"""Ordered computations (numbering, running sums, ranks, neighbours) that survive hot keys.

A window function sorts all rows of one key in one task. Above ``rows_per_segment`` rows in total
the input is cut into segments along (keys, order): each segment is a contiguous run of about that
many rows, so a key of any size is spread over as many tasks as it needs. A window inside each
segment gives the local answer and a small table of segment sums gives what to add. Below the limit
the plain window is used.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martlet.sizing import limit, segment_count, small_enough, stored

SEGMENT = "_segment"
SAMPLES_PER_SEGMENT = 8
KEYLESS_SEGMENT_ROWS = 1_000_000


@dataclass(frozen=True)
class Key:
    """One ORDER BY item. Descending items must be numeric; nulls come last there, first otherwise."""

    name: str
    descending: bool = False

    @property
    def sort(self) -> Column:
        return F.desc_nulls_last(self.name) if self.descending else F.asc_nulls_first(self.name)

    @property
    def rising(self) -> list[Column]:
        """Columns that grow in sort direction, for comparing rows as structs."""
        if not self.descending:
            return [F.col(self.name)]
        return [F.col(self.name).isNull(), -F.col(self.name)]


def asc(*names: str) -> list[Key]:
    return [Key(n) for n in names]


def desc(*names: str) -> list[Key]:
    return [Key(n, True) for n in names]


def place(order: Sequence[Key], keys: Sequence[str] = ()) -> Column:
    """A struct that compares like the rows do in ``order`` (after ``keys``)."""
    fields = [F.col(k) for k in keys] + [c for item in order for c in item.rising]
    return F.struct(*[f.alias(f"c{i}") for i, f in enumerate(fields)])


def _bounds(df: DataFrame, position: Column, rows: int, segments: int) -> DataFrame:
    """One row holding fewer than ``segments`` sorted cut points, taken from a hash sample.

    The sample only decides where to cut; every row is still computed exactly. Its size is fixed by
    the number of segments. Hashing makes the same rows qualify on every evaluation.
    """
    one_in = max(1, rows // (segments * SAMPLES_PER_SEGMENT))
    sample = df.select(position.alias("p")).where(F.pmod(F.xxhash64("p"), F.lit(one_in)) == 0)
    collected = stored(sample.agg(F.array_sort(F.collect_set("p")).alias("p")))
    step = max(1, math.ceil(collected.select(F.size("p")).first()[0] / segments))
    return stored(
        collected.select(F.filter("p", lambda _, i: (i > 0) & (i % step == 0)).alias("bounds"))
    )


def cut(
    df: DataFrame, keys: Sequence[str], order: Sequence[Key], rows_per_segment: int | None = None
) -> DataFrame | None:
    """``df`` with a segment number that never falls along (keys, order); None if one is enough."""
    rows = df.count()
    rows_per_segment = rows_per_segment or limit(df.sparkSession, "segmentRows")
    if not keys:
        # Nothing else would spread a keyless order, so give every core a segment.
        cores = df.sparkSession.sparkContext.defaultParallelism
        rows_per_segment = min(rows_per_segment, max(KEYLESS_SEGMENT_ROWS, rows // cores))
    segments = segment_count(rows, rows_per_segment)
    if segments == 1:
        return None
    position = place(order, keys)
    bounds = _bounds(df, position, rows, segments)
    # Binary search, one projection per halving: the segment is the number of bounds <= position.
    # ``get`` is null past the end, which counts as "not passed".
    out = df.withColumn(SEGMENT, F.lit(0))
    for power in range(math.ceil(math.log2(segments + 1)) - 1, -1, -1):
        step = 1 << power
        passed = F.get(bounds.scalar(), F.col(SEGMENT) + F.lit(step - 1)) <= position
        out = out.withColumn(
            SEGMENT, F.when(passed, F.col(SEGMENT) + F.lit(step)).otherwise(F.col(SEGMENT))
        )
    return out


def _window(keys: Sequence[str], *order: Column) -> WindowSpec:
    return (W.partitionBy(*keys) if keys else W).orderBy(*order)


def _add_offsets(local: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the rows to add. A segment can continue only the key its predecessor ended with, so
    there are fewer offset rows than segments and broadcasting them is safe."""
    renamed = offsets
    same = F.lit(True)
    for key in [*keys, SEGMENT]:
        renamed = renamed.withColumnRenamed(key, f"_at_{key}")
        same = same & local[key].eqNullSafe(F.col(f"_at_{key}"))
    return local.join(F.broadcast(renamed), same, "left").drop(
        SEGMENT, *[f"_at_{k}" for k in [*keys, SEGMENT]]
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Key],
    sums: dict[str, Column] | None = None,
    number: str | None = None,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Add running sums (rows from the first to the current) and, if named, the row number.

    ``order`` must identify a row within its key, so that the result is unambiguous.
    """
    sums = sums or {}
    segmented = cut(df, keys, order, rows_per_segment)
    sort = [item.sort for item in order]
    spec = _window(keys, *sort) if segmented is None else _window([SEGMENT, *keys], *sort)
    to_here = spec.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = df if segmented is None else segmented
    added = {name: F.sum(e).over(to_here) for name, e in sums.items()}
    if number:
        added[number] = F.row_number().over(spec).cast("bigint")
    local = local.withColumns(added)
    if segmented is None:
        return local

    per_segment = segmented.groupBy(*keys, SEGMENT).agg(
        F.count(F.lit(1)).alias("_add_rows"),
        *[F.sum(e).alias(f"_add_{name}") for name, e in sums.items()],
    )
    earlier = _window(keys, F.col(SEGMENT)).rowsBetween(W.unboundedPreceding, -1)
    carried = ["_add_rows", *[f"_add_{name}" for name in sums]]
    offsets = per_segment.withColumns({c: F.sum(c).over(earlier) for c in carried}).where(
        F.col("_add_rows") > 0
    )
    out = _add_offsets(local, offsets, keys)
    types = {field.name: field.dataType for field in local.schema.fields}
    total = {
        name: F.when(F.col(f"_add_{name}").isNull(), F.col(name))
        .otherwise(F.coalesce(F.col(name), F.lit(0)) + F.col(f"_add_{name}"))
        .cast(types[name])
        for name in sums
    }
    if number:
        total[number] = F.col(number) + F.coalesce("_add_rows", F.lit(0))
    return out.withColumns(total).drop(*carried)


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    by: Key,
    ties: Sequence[Key],
    rank: str,
    dense: str,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Add RANK and DENSE_RANK of ``by`` within ``keys``.

    ``ties`` only tells equal rows apart for cutting: a value shared by a third of the table may
    spread over several segments, and each of them learns the rank at which the value began.
    """
    segmented = cut(df, keys, [by, *ties], rows_per_segment)
    if segmented is None:
        spec = _window(keys, by.sort)
        return df.withColumns(
            {rank: F.rank().over(spec).cast("bigint"), dense: F.dense_rank().over(spec).cast("bigint")}
        )
    spec = _window([SEGMENT, *keys], by.sort)
    local = segmented.withColumns({rank: F.rank().over(spec), dense: F.dense_rank().over(spec)})

    value = F.struct(*[c.alias(f"v{i}") for i, c in enumerate(by.rising)])
    per_value = segmented.groupBy(*keys, SEGMENT, value.alias("_value")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    per_segment = per_value.groupBy(*keys, SEGMENT).agg(
        F.sum("_rows").alias("_n"),
        F.count(F.lit(1)).alias("_values"),
        F.min("_value").alias("_first"),
        F.max("_value").alias("_last"),
        F.max_by("_rows", "_value").alias("_n_last"),
    )
    along = _window(keys, F.col(SEGMENT))
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    steps = per_segment.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
            "_tied": F.coalesce(F.lag("_last").over(along) == F.col("_first"), F.lit(False)),
        }
    )
    steps = steps.withColumns(
        {
            "_dense_before": F.coalesce(
                F.sum(F.col("_values") - F.col("_tied").cast("int")).over(earlier), F.lit(0)
            ),
            "_began": F.min(F.col("_before") + F.col("_n") - F.col("_n_last") + 1).over(
                W.partitionBy(*keys, "_last")
            ),
        }
    )
    steps = steps.withColumn("_tie_rank", F.lag("_began").over(along))
    offsets = steps.where(F.col("_before") > 0).select(
        *keys, SEGMENT, "_before", "_dense_before", "_tied", "_first", "_tie_rank"
    )
    out = _add_offsets(local, offsets, keys)
    continues = F.coalesce(F.col("_tied") & (value == F.col("_first")), F.lit(False))
    return out.withColumns(
        {
            rank: F.when(continues, F.col("_tie_rank"))
            .otherwise(F.col(rank) + F.coalesce("_before", F.lit(0)))
            .cast("bigint"),
            dense: (
                F.col(dense)
                + F.coalesce("_dense_before", F.lit(0))
                - F.coalesce(F.col("_tied").cast("int"), F.lit(0))
            ).cast("bigint"),
        }
    ).drop("_before", "_dense_before", "_tied", "_first", "_tie_rank")


def framed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Key],
    before: int,
    after: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    Above the limit, rows are numbered first and then grouped in blocks of consecutive numbers;
    each block also receives copies of the few rows next to it, which are dropped afterwards.
    """
    rows_per_segment = rows_per_segment or limit(df.sparkSession, "segmentRows")
    if segment_count(df.count(), rows_per_segment) == 1:
        return df.withColumns(columns(_window(keys, *[item.sort for item in order])))
    # A block is at least as long as the frame, so that copies come from the next block only.
    rows_per_segment = max(rows_per_segment, before, after)
    numbered = running(df, keys, order, number="_number", rows_per_segment=rows_per_segment)
    offset = F.pmod(F.col("_number") - 1, F.lit(rows_per_segment))
    block = F.floor((F.col("_number") - 1) / rows_per_segment).cast("bigint")
    copies = F.array_compact(
        F.array(
            F.struct(block.alias("block"), F.lit(False).alias("copy")),
            F.when(
                offset >= rows_per_segment - before,
                F.struct((block + 1).alias("block"), F.lit(True).alias("copy")),
            ),
            F.when(
                (offset < after) & (block > 0),
                F.struct((block - 1).alias("block"), F.lit(True).alias("copy")),
            ),
        )
    )
    blocks = numbered.withColumn("_in", F.explode(copies)).select(
        "*", F.col("_in.block").alias("_block"), F.col("_in.copy").alias("_copy")
    )
    spec = _window([*keys, "_block"], F.col("_number"))
    return (
        blocks.withColumns(columns(spec))
        .where(~F.col("_copy"))
        .drop("_number", "_in", "_block", "_copy")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The row of every key that is greatest in ``newest_by``, compared column by column.

    Rows equal there are compared by all their other columns, so the winner never depends on the order
    of arrival. Other columns must be orderable. NULL is a key value like any other.

    This is an aggregate, not a window: each task keeps one row per key before the shuffle, so the
    copies of one key cannot pile up in a single task.
    """
    payload = [c for c in df.columns if c not in keys]
    total = [*newest_by, *[c for c in payload if c not in newest_by]]
    latest = F.max(F.struct(*[F.col(f"`{c}`") for c in total])).alias("_row")
    return df.groupBy(*keys).agg(latest).select(*keys, "_row.*").select(*df.columns)


COPIED_KEYS = 2_000_000  # as hashes, about 32 MB in every executor


def latest_of_copies(
    df: DataFrame, keys: Sequence[str], newest_by: Sequence[str], max_copied: int = COPIED_KEYS
) -> DataFrame:
    """``latest_per_key`` of a stored table in which most keys are there once. ``df`` is read twice.

    A first pass counts hashes of the keys. Rows whose hash is there once are already the latest and stay
    where they are; only the others are shuffled and compared. Equal hashes of different keys merely go the
    longer way. With more copied keys than may be broadcast, all rows go that way.
    """
    key = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    copied = stored(df.groupBy(key.alias("_copied")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_copied"))
    if not small_enough(copied, max_copied):
        return latest_per_key(df, keys, newest_by)
    alone, several = (df.join(F.broadcast(copied), key == F.col("_copied"), how) for how in ("left_anti", "left_semi"))
    return alone.unionByName(latest_per_key(several, keys, newest_by))
