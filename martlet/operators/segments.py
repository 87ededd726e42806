"""A keyword index that follows additions, replacements and deletions of its documents.

Each batch writes a segment: postings and documents with the batch as their version. A document that comes again, or
goes, leaves a tombstone: its key and the last version that is dead. Postings count when no tombstone covers them, so
scores are those of an index built anew from the documents that are there. ``merge`` rewrites neighbouring segments of
similar size as one, without what is dead, so that their number grows with the logarithm of the documents.

A batch counts once its totals are written, after all else; what an interrupted batch left is not seen and is
overwritten when it comes again. A merged segment is moved to its place whole and from then on covers its parts.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators import search
from martlet.operators.files import delete, folders, numbered_folders, rename
from martlet.operators.text import tokens
from martlet.sizing import lookup_join, spread

VERSION, UPTO = "version", "upto"


@dataclass(frozen=True, order=True)
class Segment:
    """Batches ``low`` to ``high``, with so many documents when it was written."""

    low: int
    high: int
    documents: int

    @property
    def name(self) -> str:
        return f"{self.low}-{self.high}-{self.documents}"

    def covers(self, other: Segment) -> bool:
        return self != other and self.low <= other.low and other.high <= self.high and (
            self.high - self.low > other.high - other.low)


class LiveIndex:
    """A stored index under ``path`` of documents with unique keys."""

    def __init__(self, spark: SparkSession, path: str, docs_schema, key: str, attributes: Sequence[str] = (), fan: int = 4):
        self.spark, self.path, self.key, self.attributes, self.fan = spark, path.rstrip("/"), key, tuple(attributes), fan
        self._key_type = docs_schema[key].dataType.simpleString()
        columns = ", ".join(f"`{a}` {docs_schema[a].dataType.simpleString()}" for a in self.attributes)
        self._posting_schema = f"`{key}` {self._key_type}, {columns + ', ' if columns else ''}length int, term string, tf long, {VERSION} long"
        self._document_schema = f"`{key}` {self._key_type}, length int, {VERSION} long"
        self._dead_schema = f"`{key}` {self._key_type}, length int, {UPTO} long"

    # ---- what is stored -----------------------------------------------------------------------

    def batches(self) -> list[int]:
        """Batches that are finished."""
        return numbered_folders(self.spark, f"{self.path}/totals", "after=")

    def last_batch(self) -> int | None:
        return max(self.batches(), default=None)

    def segments(self) -> list[Segment]:
        """Segments in use, oldest first: of finished batches, and not covered by a merged one."""
        done = set(self.batches())
        found = [Segment(*map(int, name.split("-"))) for name in folders(self.spark, f"{self.path}/segments")
                 if re.fullmatch(r"\d+-\d+-\d+", name)]
        seen = [s for s in found if s.low < s.high or s.low in done]
        return sorted(s for s in seen if not any(o.covers(s) for o in seen))

    def _read(self, part: str, segments: list[Segment], schema: str) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        return reader.parquet(*[f"{self.path}/segments/{s.name}/{part}" for s in segments])

    def _dead(self) -> DataFrame:
        """The last dead version of each key that has one."""
        done = set(self.batches())
        batches = [n for n in numbered_folders(self.spark, f"{self.path}/dead", "batch=") if n in done]
        if not batches:
            return self.spark.createDataFrame([], f"_key {self._key_type}, {UPTO} long")
        rows = self.spark.read.schema(self._dead_schema).parquet(*[f"{self.path}/dead/batch={n}" for n in batches])
        return rows.groupBy(F.col(self.key).alias("_key")).agg(F.max(UPTO).alias(UPTO))

    def _alive(self, rows: DataFrame) -> DataFrame:
        same = F.col(f"`{self.key}`").eqNullSafe(F.col("_key")) & (F.col(VERSION) <= F.col(UPTO))
        return lookup_join(rows, self._dead(), same, "left_anti")

    # ---- reading ------------------------------------------------------------------------------

    @property
    def postings(self) -> DataFrame:
        return self._alive(self._read("postings", self.segments(), self._posting_schema)).drop(VERSION)

    def documents(self) -> DataFrame:
        """(key, length, version) of the documents that are there."""
        return self._alive(self._read("documents", self.segments(), self._document_schema))

    @property
    def statistics(self) -> DataFrame:
        """One row: documents and tokens, kept with each batch."""
        last = self.last_batch()
        if last is None:
            return self.spark.createDataFrame([(0, 0)], "documents long, tokens long")
        return self.spark.read.schema("documents long, tokens long").parquet(f"{self.path}/totals/after={last}")

    def terms(self, query: str) -> list[str]:
        row = self.spark.range(1).select(F.array_distinct(tokens(F.lit(query))).alias("t")).first()
        return row["t"]

    def keyword_scores(self, query: str, equal: dict | None = None) -> DataFrame:
        """``key``, ``score`` of every document that has a term of the query."""
        return search.bm25(self.postings, self.statistics, self.terms(query), self.key, equal)

    # ---- writing ------------------------------------------------------------------------------

    def refresh(self, batch_id: int, docs: DataFrame | None, text: str, removed: DataFrame | None = None) -> bool:
        """Index new and changed ``docs`` (one row for each key) and forget the keys of ``removed``.

        A batch that is done already changes nothing and gives False; batches come in order of their number.
        """
        before = self.last_batch()
        if before is not None and batch_id <= before:
            return False
        keys = [d.select(self.key) for d in (docs, removed) if d is not None]
        counts = {"documents": 0, "tokens": 0}
        if before is not None:
            counts = self.statistics.first().asDict()
        if keys and before is not None:
            touched = reduce(DataFrame.union, keys).distinct().withColumnRenamed(self.key, "_touched")
            same = F.col(f"`{self.key}`").eqNullSafe(F.col("_touched"))
            gone = lookup_join(self.documents(), touched, same, "left_semi").select(
                self.key, "length", F.lit(batch_id - 1).cast("long").alias(UPTO))
            gone.write.mode("overwrite").parquet(f"{self.path}/dead/batch={batch_id}")
            lost = self.spark.read.schema(self._dead_schema).parquet(f"{self.path}/dead/batch={batch_id}").agg(
                F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
            counts = {"documents": counts["documents"] - lost[0], "tokens": counts["tokens"] - lost[1]}
        if docs is not None:
            version = F.lit(batch_id).cast("long").alias(VERSION)
            whole = spread(docs)
            new = search.postings(whole, self.key, text, self.attributes).select("*", version)
            sized = whole.select(self.key, F.greatest(F.size(tokens(F.col(text))), F.lit(0)).alias("length"), version)
            with search.written_first(new, self.path) as rows:
                segment = self._write(batch_id, batch_id, rows, sized)
            added = self._read("documents", [segment], self._document_schema).agg(F.coalesce(F.sum("length"), F.lit(0))).first()
            counts = {"documents": counts["documents"] + segment.documents, "tokens": counts["tokens"] + added[0]}
        totals = self.spark.createDataFrame([(counts["documents"], counts["tokens"])], "documents long, tokens long")
        totals.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/totals/after={batch_id}")
        return True

    def _write(self, low: int, high: int, postings: DataFrame, documents: DataFrame) -> Segment:
        """Write a segment aside and move it to its place, over what an earlier try left there."""
        aside = f"{self.path}/segments/aside-{uuid.uuid4().hex}"
        # Sorting by term lets a reader skip the row groups of other terms; the key splits frequent ones over files.
        postings.select(*[c.split()[0].strip("`") for c in self._posting_schema.split(", ")]).repartitionByRange(
            "term", self.key).sortWithinPartitions("term", self.key).write.parquet(f"{aside}/postings")
        documents.select(self.key, "length", VERSION).write.parquet(f"{aside}/documents")
        count = self.spark.read.schema(self._document_schema).parquet(f"{aside}/documents").count()
        segment = Segment(low, high, count)
        for name in folders(self.spark, f"{self.path}/segments"):
            if name.startswith(f"{low}-{high}-"):
                delete(self.spark, f"{self.path}/segments/{name}")
        rename(self.spark, aside, f"{self.path}/segments/{segment.name}")
        return segment

    def _tier(self, segment: Segment) -> int:
        return int(math.log(max(segment.documents, 1), self.fan) + 1e-9)

    def merge(self) -> list[Segment]:
        """Merge the newest segments while ``fan`` or more of them are of one size tier, or smaller; the new ones."""
        made = []
        while True:
            segments = self.segments()
            run: list[Segment] = []
            for tier in sorted({self._tier(s) for s in segments}):
                run = []
                for s in reversed(segments):
                    if self._tier(s) > tier:
                        break
                    run.insert(0, s)
                if len(run) >= self.fan:
                    break
            if len(run) < self.fan:
                return made
            made.append(self._write(
                run[0].low, run[-1].high, self._alive(self._read("postings", run, self._posting_schema)),
                self._alive(self._read("documents", run, self._document_schema))))

    def vacuum(self) -> list[str]:
        """Delete segments that a merged one covers, and tombstones of versions that no segment holds any more.

        Call it when no reader of the older files is left.
        """
        used = self.segments()
        names = {s.name for s in used}
        last = self.last_batch()
        gone = []
        for name in folders(self.spark, f"{self.path}/segments"):
            if name not in names and (name.startswith("aside-") or (last is not None and int(name.split("-")[1]) <= last)):
                delete(self.spark, f"{self.path}/segments/{name}")
                gone.append(name)
        # A merged segment left out all that was dead when it was written: tombstones up to its last batch matter only
        # to segments before it.
        for batch in numbered_folders(self.spark, f"{self.path}/dead", "batch="):
            if used and used[0].low < used[0].high and batch <= used[0].high:
                delete(self.spark, f"{self.path}/dead/batch={batch}")
                gone.append(f"dead {batch}")
        return gone
