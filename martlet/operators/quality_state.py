"""Quality checks whose state is kept for each batch and merged with the next.

A batch is read once and leaves: rows and NULLs of each checked column, the values of columns that should have a known
number of them, the attribute combinations of keys that should have one, and how often each key occurs, in hash
partitions. Checks over everything so far merge these states, which are as small as the distinct keys; no earlier
row is read again. ``fold`` merges the states themselves, so that few are read. A state is written aside and moved to
its place whole, so an interrupted batch leaves none and can come again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.files import delete, numbered_folders, rename

PARTS = ("nulls", "valuesets", "versions", "keys")


class QualityStates:
    """States under ``path`` for rows like ``schema``.

    ``key`` should be unique, ``not_null`` columns filled, ``counted`` columns are counted by distinct values, and each
    column in ``consistent`` should determine its attributes.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], not_null: Sequence[str],
        counted: Sequence[str] = (), consistent: dict[str, Sequence[str]] | None = None, parts: int = 16,
    ):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self.key, self.not_null, self.counted, self.consistent = list(key), list(not_null), list(counted), consistent or {}
        texts = "name string, value string"
        self.schemas = {
            "nulls": "column_name string, n long", "valuesets": texts, "versions": "name string, id string, version string",
            "keys": T.StructType([*[schema[k] for k in self.key], T.StructField("n", T.LongType()), T.StructField("part", T.IntegerType())])}

    def _folders(self) -> list[str]:
        """The newest folded state and those of the batches after it."""
        base = self._base()
        later = [n for n in numbered_folders(self.spark, self.path, "batch=") if base is None or n > base]
        return [*([] if base is None else [f"upto={base}"]), *[f"batch={n}" for n in later]]

    def _base(self) -> int | None:
        return max(numbered_folders(self.spark, self.path, "upto="), default=None)

    def last_batch(self) -> int | None:
        found = [self._base(), *numbered_folders(self.spark, self.path, "batch=")]
        return max((n for n in found if n is not None), default=None)

    def _read(self, part: str) -> DataFrame:
        frames = [self.spark.read.schema(self.schemas[part]).parquet(f"{self.path}/{f}/{part}") for f in self._folders()]
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], self.schemas[part])

    def _publish(self, states: dict[str, DataFrame], name: str) -> None:
        aside = f"{self.path}/aside-{uuid.uuid4().hex}"
        for part, rows in states.items():
            writer = rows.write
            (writer.partitionBy("part") if part == "keys" else writer).parquet(f"{aside}/{part}")
        rename(self.spark, aside, f"{self.path}/{name}")

    def _merged(self, part: str, rows: DataFrame) -> DataFrame:
        if part == "nulls":
            return rows.groupBy("column_name").agg(F.sum("n").alias("n"))
        if part == "keys":
            return rows.groupBy("part", *self.key).agg(F.sum("n").alias("n"))
        return rows.distinct()

    def add(self, batch: int, rows: DataFrame) -> bool:
        """Take up a batch; batches come in order of their number, one that is there already gives False."""
        last = self.last_batch()
        if last is not None and batch <= last:
            return False
        text = lambda c: F.col(c).cast("string")
        counts = rows.agg(F.count(F.lit(1)).alias("*"), *[F.count_if(F.col(c).isNull()).alias(c) for c in self.not_null])
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n")) for c in ("*", *self.not_null)]
        values = [rows.where(F.col(c).isNotNull()).select(F.lit(c).alias("name"), text(c).alias("value")) for c in self.counted]
        versions = [
            rows.select(*dict.fromkeys([c, *attributes])).distinct().select(  # text is made of distinct rows only
                F.lit(c).alias("name"), text(c).alias("id"), F.to_json(F.struct(*attributes)).alias("version"))
            for c, attributes in self.consistent.items()]
        none = lambda part: [self.spark.createDataFrame([], self.schemas[part])]
        part = F.pmod(F.hash(*self.key), F.lit(self.parts)).alias("part")
        self._publish({
            "nulls": counts.select(F.inline(F.array(*pairs))),
            "valuesets": reduce(DataFrame.unionByName, none("valuesets") + values).distinct(),
            "versions": reduce(DataFrame.unionByName, none("versions") + versions).distinct(),
            "keys": rows.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n")).select("*", part).repartition("part"),
        }, f"batch={batch}")
        return True

    def findings(self) -> DataFrame:
        """(check, name, found): rows, NULLs, duplicate keys, distinct values and inconsistent keys of all batches."""
        nulls = self._merged("nulls", self._read("nulls"))
        counts = nulls.select(
            F.when(F.col("column_name") == "*", "rows").otherwise("nulls").alias("check"),
            F.col("column_name").alias("name"), F.col("n").alias("found"))
        twice = self._merged("keys", self._read("keys")).where("n > 1").agg(F.count(F.lit(1)).alias("found"))
        unique = twice.select(F.lit("duplicate keys").alias("check"), F.lit(", ".join(self.key)).alias("name"), "found")
        distinct = self._merged("valuesets", self._read("valuesets")).groupBy("name").agg(F.count(F.lit(1)).alias("found"))
        versions = self._merged("versions", self._read("versions")).groupBy("name", "id").agg(F.count(F.lit(1)).alias("n"))
        drifted = versions.groupBy("name").agg(F.count_if(F.col("n") > 1).alias("found"))
        out = counts.unionByName(unique)
        for check, rows in (("distinct values", distinct), ("inconsistent", drifted)):
            out = out.unionByName(rows.select(F.lit(check).alias("check"), "name", "found"))
        return out

    def fold(self) -> int | None:
        """Merge all states into one, so that a check reads one of each kind; what it replaces goes."""
        folders, last = self._folders(), self.last_batch()
        if len(folders) > 1:
            self._publish({p: self._merged(p, self._read(p)) for p in PARTS}, f"upto={last}")
            for folder in folders:
                delete(self.spark, f"{self.path}/{folder}")
        return last
