"""Which keys a stored table already holds, kept as streaming state instead of being read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadledger.session import deleted, fresh_path, written
from roadledger.sources.warehouse import Warehouse

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class SeenKeys:
    """Keys of a table partitioned by batch, in a state store on disk (RocksDB) without expiry.

    The table itself is a file stream, and so are the keys that an epoch asks for. One streaming aggregation over both
    keeps for every key the least and greatest batch that holds it, combined before its shuffle. A call runs it over
    what is new: the files that came since the last call, and the keys asked for. So the rows an epoch reads do not
    depend on how much the table holds; only the first call reads a table that is already there.

    A batch that is written again changes nothing, and a batch never meets itself: keys count as seen if some other
    batch holds them, which the least and the greatest batch tell.
    """

    def __init__(self, warehouse: Warehouse, table: str, key: str):
        self.warehouse, self.table, self.key = warehouse, table, key
        self.folder = f"{warehouse.root}/_seen/{table}-{key}"
        #: Rows the last call read.
        self.rows_read = 0

    def held_elsewhere(self, keys: DataFrame, epoch: int, batch_id: str) -> DataFrame:
        """The distinct rows of ``keys`` (the key column alone) that another batch than ``batch_id`` holds; written. Keys
        are better given once, but not made distinct here: the state does that as well."""
        spark, key = self.warehouse.spark, self.key
        asked_path, answers = f"{self.folder}/asked/epoch={epoch}", fresh_path(spark, "answers")
        # Written again with an epoch: new files, so the store sees the keys again and answers again.
        keys.select(key).write.mode("overwrite").option("compression", "zstd").parquet(asked_path)

        def answer(changed: DataFrame, number: int) -> None:
            here = changed.where((F.col("asked") == epoch) & ((F.col("low") != batch_id) | (F.col("high") != batch_id)))
            here.select(key).write.mode("overwrite").parquet(f"{answers}/part={number}")

        before = spark.conf.get(PROVIDER, None)
        spark.conf.set(PROVIDER, ROCKSDB)
        try:
            run = (self._state(keys.schema[key].dataType.simpleString()).writeStream.outputMode("update").foreachBatch(answer)
                   .option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start())
            run.awaitTermination()
        finally:
            spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
        self.rows_read = sum(p.numInputRows for p in run.recentProgress)
        kind = keys.schema[key].dataType.simpleString()
        found = written(spark.read.schema(f"`{key}` {kind}").parquet(answers).distinct(), "seen") if self.rows_read else keys.limit(0)
        deleted(spark, answers)
        deleted(spark, asked_path)
        return found

    def _state(self, kind: str) -> DataFrame:
        spark, key = self.warehouse.spark, self.key
        source = spark.readStream.option("ignoreMissingFiles", "true")
        nothing = {"batch_id": F.lit(None).cast("string"), "epoch": F.lit(None).cast("bigint")}
        held = source.schema(f"`{key}` {kind}, batch_id string").parquet(self.warehouse.path(self.table)).select(
            key, "batch_id", nothing["epoch"].alias("epoch"))
        asked = source.schema(f"`{key}` {kind}, epoch bigint").parquet(f"{self.folder}/asked").select(
            key, nothing["batch_id"].alias("batch_id"), "epoch")
        return held.unionByName(asked).groupBy(key).agg(
            F.min("batch_id").alias("low"), F.max("batch_id").alias("high"), F.max("epoch").alias("asked"))
