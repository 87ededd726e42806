"""Load, merge and check as one run. Scheduling it is left to the caller."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from martlet.operators import history
from martlet.plans.mart import FACT_KEY
from martlet.sizing import tasks_for
from martlet.streaming import incremental


FACT_LOG_SCHEMA = (
    "event_id string, user_id string, event_time timestamp_ntz, sku string, product_name string, "
    "category string, qty bigint, price decimal(10,2), line_amount decimal(12,2), "
    "src_filename string, _op string, commit_ts timestamp_ntz, inserted_at timestamp_ntz, "
    "_batch_id bigint"
)


@dataclass(frozen=True)
class Paths:
    """Folders of one pipeline under a common root on shared storage."""

    root: str
    landing: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw_events"

    def fact_log(self, schema: str) -> str:
        return f"{self.root}/{schema}/fact_log"

    def checkpoint(self, step: str) -> str:
        return f"{self.root}/checkpoints/{step}"


def fact(spark: SparkSession, paths: Paths, target_schema: str = "mart") -> DataFrame:
    """Current state of the purchase fact: its newest base and the batches since."""
    log = history.read_folded(spark, paths.fact_log(target_schema), FACT_LOG_SCHEMA)
    return history.current_state(log, FACT_KEY, tasks_for(log))


def run(
    spark: SparkSession, paths: Paths, target_schema: str = "mart", on_error: str = "continue",
    fold_after: int = 16,
) -> int:
    """One pass: new files to RAW, new RAW rows to the fact, and its row count.

    A step that fails raises, so later steps do not run and the next pass starts where this one
    stopped. An empty fact is an error. After ``fold_after`` batches they are folded into a new base, so
    a pass reads the fact once and a bounded number of batches, however long the history is.
    """
    incremental.start_load(
        spark, paths.landing, paths.raw, paths.checkpoint("load"), on_error).awaitTermination()
    incremental.start_merge(
        spark, paths.raw, paths.fact_log(target_schema),
        paths.checkpoint(f"merge_{target_schema}")).awaitTermination()
    log = paths.fact_log(target_schema)
    if len(history.open_batches(spark, log)) >= fold_after:
        history.fold(spark, log, FACT_KEY, FACT_LOG_SCHEMA)
    rows = fact(spark, paths, target_schema).count()
    if rows == 0:
        raise RuntimeError("the purchase fact is empty")
    return rows
