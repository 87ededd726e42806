"""Joins of a large, possibly skewed fact with its dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.sizing import lookup_join, small_enough


def star_totals(
    fact: DataFrame,
    dimensions: Sequence[tuple[DataFrame, str]],
    by: Sequence[str],
    sums: dict[str, str],
    max_rows: int | None = None,
) -> DataFrame:
    """``sum`` of fact columns by dimension attributes.

    Small dimensions are broadcast and the fact is aggregated once, after the joins. When one of
    them is too large, the fact is first summed per combination of its join keys, so that a key with
    a third of all rows enters the shuffle join as a few partial sums. Each dimension must be unique
    on its key.
    """
    sides = [(side, key, small_enough(side, max_rows)) for side, key in dimensions]
    joined = fact
    if not all(small for _, _, small in sides):
        joined = joined.groupBy(*[key for _, key in dimensions]).agg(
            *[F.sum(column).alias(column) for column in dict.fromkeys(sums.values())]
        )
    for side, key, small in sides:
        joined = joined.join(F.broadcast(side) if small else side, key)
    return joined.groupBy(*by).agg(*[F.sum(column).alias(name) for name, column in sums.items()])


def keep_lookup_rows(
    fact: DataFrame, lookup: DataFrame, key: str, max_rows: int | None = None
) -> DataFrame:
    """``fact RIGHT JOIN lookup``: matches plus the lookup rows no fact row refers to.

    A right join cannot split a hot fact key over several tasks; an inner join can, and the
    unmatched side only needs the distinct keys of the fact.
    """
    matched = lookup_join(fact, lookup, key, "inner", max_rows)
    missing = lookup.join(fact.select(key).distinct(), key, "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)


def unmatched(
    fact: DataFrame, lookup: DataFrame, key: str, lookup_key: str, max_rows: int | None = None
) -> DataFrame:
    """``fact FULL JOIN lookup`` reduced to the rows of either side that found no partner.

    ``lookup_key`` names the lookup's own key in the result; it is NULL on rows of the fact.
    """
    alone = lookup_join(fact, lookup.select(key), key, "left_anti", max_rows)
    missing = lookup.join(fact.select(key).distinct(), key, "left_anti").withColumnRenamed(
        key, lookup_key
    )
    return alone.unionByName(missing, allowMissingColumns=True)
