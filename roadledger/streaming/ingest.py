"""Incremental ingestion: every micro-batch passes the gate and is stored with its audit row."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from roadledger.operators.gate import MESSAGES, Rule, accounting, envelopes, first_failure, incident_rules, passed
from roadledger.operators.dedup import flag_repeats
from roadledger.operators.joins import sized_join
from roadledger.session import scratch, written
from roadledger.sources.collisions import audit
from roadledger.sources.warehouse import Warehouse
from roadledger.streaming.keyed_state import SeenKeys


def already_known(rows: DataFrame, seen: SeenKeys, epoch: int, batch_id: str) -> DataFrame:
    """``rows`` with ``is_known``: whether the key was accepted in another batch.

    The keys of this micro-batch, of which the rows that are no repeats hold each once, are looked up in the state
    store; only the hits are joined to the rows. A null key equals a null key, as in the batch gate.
    """
    hits = seen.held_elsewhere(rows.where("NOT is_repeat").select(seen.key), epoch, batch_id)
    return sized_join(rows, hits.withColumn("is_known", F.lit(True)), [seen.key], "left", null_safe=True).withColumn(
        "is_known", F.coalesce("is_known", F.lit(False)))


def gate_batch(warehouse: Warehouse, key: str = "accident_index", prefix: str = "stream_",
               source: str = "stream", order: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    """The micro-batch function. Its batch id is the epoch, and each table gets that partition
    written whole, so an epoch that is run again replaces its own rows. What it wrote on the way is
    removed when it is done; the keys accepted so far stay in a state store beside the tables."""
    seen = SeenKeys(warehouse, "stg_incidents", key)

    def run(rows: DataFrame, epoch: int) -> None:
        with scratch(warehouse.spark):
            judge(rows, epoch)

    def judge(rows: DataFrame, epoch: int) -> None:
        started = datetime.now(timezone.utc)
        batch_id = f"{prefix}{epoch:08d}"
        arrived = written(rows.withColumns({
            "arrival": F.monotonically_increasing_id(), "ingested_at": F.current_timestamp(),
            "batch_id": F.lit(batch_id)}), "arrived")
        flagged = already_known(flag_repeats(arrived, [key], [*order, "arrival"], ["arrival"]), seen, epoch, batch_id)
        repeated = Rule("DUPLICATE_ACCIDENT_INDEX", MESSAGES["DUPLICATE_ACCIDENT_INDEX"], F.col("is_known"))
        judged = written(flagged.withColumn("rejection_reason", first_failure([*incident_rules(), repeated]))
                         .drop("is_repeat", "is_known"), "judged")
        counts = accounting(judged).first()
        records = envelopes(judged, source, key, rows.columns, ordinal="arrival").withColumns({
            "rejected_at": F.current_timestamp(), "rejection_id": F.col("arrival")})
        warehouse.put_batch("quarantine", records, batch_id)
        warehouse.put_batch("stg_incidents", passed(judged), batch_id)
        done = warehouse.read("ingestion_audit").where(F.col("batch_id") == batch_id)
        if done.isEmpty():
            audit(warehouse, batch_id, source, f"epoch {epoch}", counts["valid"], counts["rejected"], started)

    return run


def stream_ingest(stream: DataFrame, warehouse: Warehouse, checkpoint: str, key: str = "accident_index",
                  order: tuple[str, ...] = ()) -> StreamingQuery:
    """Runs everything available through the gate; valid rows land in staging, the rest in quarantine."""
    warehouse.init()
    return (stream.writeStream.foreachBatch(gate_batch(warehouse, key, order=order))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
