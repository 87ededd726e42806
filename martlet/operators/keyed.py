"""A table with a key: a bucketed base and batches of changes with the rows before and after.

``merge`` looks up the present row of each key in a batch and writes key, row before and row after as one batch.
From then on

* batches are bucketed as the base is, so the rows of a key meet each other and the base without a shuffle,
* the state is the base joined with the last row of each key that later batches hold,
* the change feed between two batches is the first row before and the last row after of each key in the
  batches between, and reads no others,
* cost follows the batch. The base is a bucketed table on a hash of the key, so it meets a batch without being
  shuffled; when few keys are looked up, only their buckets are opened, and in them only row groups that can hold them.

NULL is a key value like any other: rows meet on the hash, and then on each key column with NULL equal to NULL.
``fold`` stores the state as a new base, published by one rename. Base files outlive the application; their
entry in the session's catalogue is made again when it is missing.
"""

from __future__ import annotations

import copy
import hashlib
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.files import delete, exists, make, numbered_folders, rename
from martlet.sizing import limit, lookup_join, stored

HASH, BATCH, COMMIT, INSERTED = "_hash", "_batch", "commit_ts", "inserted_at"
BEFORE, AFTER = "_before", "_after"


def key_hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in key])


def join_keys(left: DataFrame, right: DataFrame, key: Sequence[str], how: str, max_rows: int | None = None) -> DataFrame:
    """Join on equal keys, NULL equal to NULL, beside an equality of hashes; keys of ``right`` are dropped.

    Written without ``<=>``, which would make each key column part of what both sides are distributed by. With
    ``max_rows`` the right side is broadcast if it is measured to have no more.
    """
    others = [F.col(c) for c in right.columns if c != HASH and c not in key]
    beside = right.select(
        F.col(HASH).alias("_right"), *[F.col(f"`{k}`").alias(f"_right_{i}") for i, k in enumerate(key)], *others)
    pairs = [(F.col(f"`{k}`"), F.col(f"_right_{i}")) for i, k in enumerate(key)]
    each = [F.coalesce(a == b, a.isNull() & b.isNull()) for a, b in pairs]
    on = (F.col(HASH) == F.col("_right")) & reduce(lambda a, b: a & b, each)
    if max_rows is not None:
        return lookup_join(left, beside, on, how, max_rows)
    return left.join(beside, on, how)


class KeyedTable:
    """A table under ``path`` whose rows of ``schema`` are unique by ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets
        self.rows = T.StructType([*schema.fields, T.StructField(INSERTED, T.TimestampNTZType())])
        named = T.StructType([T.StructField(HASH, T.LongType()), *[schema[k] for k in self.key]])
        self._base_schema = T.StructType([T.StructField(HASH, T.LongType()), *self.rows.fields])
        self._change_schema = T.StructType([
            *named.fields, T.StructField(BEFORE, self.rows), T.StructField(AFTER, self.rows),
            T.StructField(COMMIT, T.TimestampNTZType()), T.StructField(BATCH, T.LongType())])

    def on(self, spark: SparkSession) -> KeyedTable:
        """The same table in another session, such as that of a streaming query's batch."""
        other = copy.copy(self)
        other.spark = spark
        return other

    # ---- what is stored -----------------------------------------------------------------------

    def batches(self) -> list[int]:
        return numbered_folders(self.spark, f"{self.path}/changes", f"{BATCH}=")

    def base_batch(self) -> int | None:
        """Last batch that the newest base holds."""
        return max(numbered_folders(self.spark, f"{self.path}/base", "upto="), default=None)

    def last_batch(self) -> int | None:
        return max([*self.batches(), *([] if (base := self.base_batch()) is None else [base])], default=None)

    def _bucketed(self, where: str, columns: T.StructType, partitioned: str = "") -> DataFrame:
        """The bucketed files under ``where``, by an entry of the session's catalogue."""
        name = "keyed_" + hashlib.sha256(where.encode()).hexdigest()[:24]
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} ({columns.toDDL()}) USING parquet {partitioned} CLUSTERED BY ({HASH}) SORTED BY ({HASH}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{where}'")
        if partitioned:  # folders may have come or gone
            self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        return self.spark.table(name)

    def base(self) -> DataFrame | None:
        upto = self.base_batch()
        return None if upto is None else self._bucketed(f"{self.path}/base/upto={upto}", self._base_schema)

    def _span(self, after: int | None, upto: int | None) -> list[int]:
        return [n for n in self.batches() if (after is None or n > after) and (upto is None or n <= upto)]

    def changes(self, after: int | None = None, upto: int | None = None) -> DataFrame:
        """Rows of the batches in (after, upto]; folders of other batches are not opened."""
        if not exists(self.spark, f"{self.path}/changes"):
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self._change_schema])
        rows = self._bucketed(f"{self.path}/changes", self._change_schema, f"PARTITIONED BY ({BATCH})")
        if after is not None:
            rows = rows.where(F.col(BATCH) > after)
        return rows if upto is None else rows.where(F.col(BATCH) <= upto)

    def _net(self, after: int | None = None, upto: int | None = None) -> DataFrame:
        """First row before and last row after of each key in the batches. One batch has them as it is."""
        changes = self.changes(after, upto)
        if len(self._span(after, upto)) == 1:
            return changes.select(HASH, *self.key, BEFORE, AFTER)
        return self._grouped(changes)

    def _grouped(self, changes: DataFrame) -> DataFrame:
        return changes.groupBy(HASH, *self.key).agg(
            F.min_by(BEFORE, BATCH).alias(BEFORE), F.max_by(AFTER, BATCH).alias(AFTER))

    # ---- reading ------------------------------------------------------------------------------

    def state(self) -> DataFrame:
        """The present rows with the time each was inserted."""
        base = self.base()
        later = self._net(after=self.base_batch())
        if base is None:
            kept = later.where(F.col(AFTER).isNotNull())
            return kept.select(f"{AFTER}.*")
        packed = base.select(HASH, *self.key, F.struct(*self.rows.names).alias("_row"))
        both = join_keys(packed, later, self.key, "full")
        row = F.when(F.col("_right").isNotNull(), F.col(AFTER)).otherwise(F.col("_row"))
        return both.select(row.alias("_row")).where(F.col("_row").isNotNull()).select("_row.*")

    def _few(self, keys: DataFrame) -> list[int] | None:
        """Hashes of ``keys`` if they are few enough to be looked up one by one."""
        most = limit(self.spark, "lookupKeys")
        found = [r[0] for r in keys.select(HASH).limit(most + 1).collect()]
        return found if len(found) <= most else None

    def present(self, keys: DataFrame) -> DataFrame:
        """``keys`` (_hash, distinct keys and further columns) with ``_row``: the present row of each, NULL if there is none.

        Only ``keys`` are shuffled, and not even these if they lie in the table's buckets already.
        """
        return self._beside(keys, self._few(keys))

    def _beside(self, keys: DataFrame, few: list[int] | None) -> DataFrame:
        base, later = self.base(), self._net(after=self.base_batch()).select(HASH, *self.key, F.col(AFTER).alias("_later"))
        if few is not None:
            later = later.where(F.col(HASH).isin(few))
            base = base if base is None else base.where(F.col(HASH).isin(few))
        out = join_keys(keys, later, self.key, "left").withColumnRenamed("_right", "_in_later").drop(
            *[f"_right_{i}" for i in range(len(self.key))])
        kept = F.lit(None).cast(self.rows)
        if base is not None:
            rows = base.select(HASH, *self.key, F.struct(*self.rows.names).alias("_kept"))
            out, kept = join_keys(out, rows, self.key, "left"), F.col("_kept")
        row = F.when(F.col("_in_later").isNotNull(), F.col("_later")).otherwise(kept).alias("_row")
        return out.select(*keys.columns, row)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """(_hash, key, _row) of those of ``keys`` (_hash and key columns, distinct) that are in the table."""
        return self.present(keys).where(F.col("_row").isNotNull())

    def feed(self, after: int | None = None, upto: int | None = None) -> DataFrame:
        """What the batches in (after, upto] changed: rows with ``_action`` and ``_is_update``.

        Raises if batches of the span have been expired. One net change for each key: a row that came and went between leaves nothing, an update is a DELETE of the
        old row and an INSERT of the new one. Only these batches are read.
        """
        given_up = max(numbered_folders(self.spark, f"{self.path}/expired", "upto="), default=None)
        if given_up is not None and (after is None or after < given_up):
            raise ValueError(f"changes up to batch {given_up} have been expired")
        net = self._net(after, upto).where(~F.col(BEFORE).eqNullSafe(F.col(AFTER)))
        is_update = F.col(BEFORE).isNotNull() & F.col(AFTER).isNotNull()
        each = F.array_compact(F.array(*[
            F.when(F.col(image).isNotNull(), F.struct(F.lit(action).alias("action"), F.col(image).alias("row")))
            for image, action in ((BEFORE, "DELETE"), (AFTER, "INSERT"))]))
        rows = net.select(is_update.alias("_is_update"), F.explode(each).alias("_change"))
        return rows.select("_change.row.*", F.col("_change.action").alias("_action"), "_is_update")

    # ---- writing ------------------------------------------------------------------------------

    def merge(
        self, batch_id: int, upserts: DataFrame | None, deletes: DataFrame | None, commit_ts: Column,
        update: bool = True, insert: bool = True,
    ) -> bool:
        """Write one batch: ``upserts`` hold one row for each key, ``deletes`` (key columns) none of the same keys.

        Without ``update`` keys that are there stay as they are, without ``insert`` new ones are left out. A batch
        that is already there, or in the base, changes nothing and gives False; batches come in order of their number.
        """
        last = self.last_batch()
        if batch_id in self.batches() or (last is not None and batch_id <= last):
            return False
        rows = upserts if upserts is not None else self.spark.createDataFrame([], T.StructType(self.rows.fields[:-1]))
        columns = self.rows.names[:-1]
        new = rows.select(key_hash(self.key).alias(HASH), *self.key, F.struct(*columns).alias("_new"))
        if deletes is not None:
            gone = deletes.select(key_hash(self.key).alias(HASH), *self.key).distinct()
            new = new.unionByName(gone, allowMissingColumns=True)
        if last is None:
            both = self._by_bucket(new).withColumn("_row", F.lit(None).cast(self.rows))
        else:
            new = stored(new)  # read for its hashes and for the join
            both = self._beside(self._by_bucket(new), self._few(new))
        both = both.withColumnRenamed("_row", BEFORE)
        stamp = F.coalesce(F.col(f"{BEFORE}.{INSERTED}"), commit_ts.cast("timestamp_ntz"))
        after = F.struct(*[F.col(f"_new.{c}").cast(self.rows[c].dataType).alias(c) for c in columns], stamp.alias(INSERTED))
        changed = both.withColumn(AFTER, F.when(F.col("_new").isNotNull(), after)).drop("_new")
        if not update:
            changed = changed.where(F.col(BEFORE).isNull() | F.col(AFTER).isNull())
        if not insert:
            changed = changed.where(F.col(BEFORE).isNotNull())
        changed = changed.where(~F.col(BEFORE).eqNullSafe(F.col(AFTER)))
        self._write(changed.withColumn(COMMIT, commit_ts.cast("timestamp_ntz")), f"changes/{BATCH}={batch_id}")
        return True

    def _by_bucket(self, new: DataFrame) -> DataFrame:
        """One row of each key, in as many partitions as there are buckets."""
        return new.repartition(self.buckets, HASH).groupBy(HASH, *self.key).agg(F.first("_new").alias("_new"))

    def _write(self, rows: DataFrame, to: str) -> None:
        """Write ``rows``, which lie in partitions by bucket, aside and move them to their place whole."""
        name = "aside_" + uuid.uuid4().hex
        aside = f"{self.path}/aside/{name}"
        (rows.write.format("parquet").option("compression", "zstd").bucketBy(self.buckets, HASH).sortBy(HASH)
         .option("path", aside).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # the entry only: the files stay
        make(self.spark, f"{self.path}/{to.split('/')[0]}")
        rename(self.spark, aside, f"{self.path}/{to}")

    def fold(self) -> int | None:
        """Store the state as a new base. Batches stay for feeds; bases that it replaces go with ``expire``."""
        last = self.last_batch()
        if last is None or last == self.base_batch():
            return last
        if self.base_batch() is None:  # grouped in the buckets they have, one batch too
            rows = self._grouped(self.changes()).where(F.col(AFTER).isNotNull()).select(HASH, f"{AFTER}.*")
        else:
            rows = self.state().select(key_hash(self.key).alias(HASH), *self.rows.names).repartition(self.buckets, HASH)
        self._write(rows, f"base/upto={last}")
        return last

    def expire(self, keep_after: int) -> list[int]:
        """Delete bases but the newest, and batches up to ``keep_after`` that it holds; feeds from then on are given up."""
        base = self.base_batch()
        if base is None:
            return []
        for older in numbered_folders(self.spark, f"{self.path}/base", "upto="):
            if older < base:
                delete(self.spark, f"{self.path}/base/upto={older}")
        held = [n for n in self.batches() if n <= min(base, keep_after)]
        if held:
            make(self.spark, f"{self.path}/expired/upto={held[-1]}")
        for batch in held:
            delete(self.spark, f"{self.path}/changes/{BATCH}={batch}")
        return held
