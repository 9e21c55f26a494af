"""Stream sinks (K16, K17, K19, ST12, ST15).

* ``start_file_sink``: append to Parquet; exactly-once through the file sink
  log in the checkpoint.
* ``UpsertSink``: keyed upsert for ``foreachBatch`` (the primary-key table of
  the modelled jobs): merge with the touched folders, checkpoint, dynamic
  partition overwrite; the batch id is a column, so a replay changes nothing.
* ``jdbc_append``: ``foreachBatch`` append into a database table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farebox.operators.joins import anti_join, semi_join
from farebox.operators.sinks import PartitionedTable, materialize


STATE_STORE_CONF = {
    # State on local disk in RocksDB instead of executor heap; changelog
    # checkpointing uploads only the changes of each micro-batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare_state_store(spark) -> None:
    """Use RocksDB for streaming state unless the session already chose a
    provider (a query keeps the provider recorded in its checkpoint)."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None):
        return
    for key, value in STATE_STORE_CONF.items():
        spark.conf.set(key, value)


def start_file_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = True,
    interval: str = "10 seconds",
    fmt: str = "parquet",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """ST12: checkpointed file sink; ``available_now`` drains the input and
    stops (tests, back-fills); otherwise a processing-time trigger.
    ``state_partitions`` fixes the state's partitions when the checkpoint is
    new (the session's shuffle partitions otherwise)."""
    if state_partitions:
        conf, key = df.sparkSession.conf, "spark.sql.shuffle.partitions"
        before = conf.get(key)
        conf.set(key, str(state_partitions))
        try:
            return start_file_sink(df, path, checkpoint, mode, available_now, interval, fmt)
        finally:
            conf.set(key, before)
    w = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).option("path", path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def start_console(df: DataFrame, rows: int = 10, mode: str = "append") -> StreamingQuery:
    """Print the first rows of each micro-batch."""
    return df.writeStream.format("console").outputMode(mode).option("numRows", rows).start()


class UpsertSink:
    """K16 / ST15: ``foreachBatch`` target keeping the last row per key.

    A ``PartitionedTable`` in folders by ``unit`` of ``time_key`` (a key column
    such as the window start: a micro-batch touches the recent folders), or by
    hash bucket of the keys.  A batch merges with the rows of the folders it
    touches and overwrites those.  Every row keeps the id of the batch that
    wrote it (``fb_batch``): a replayed batch replaces its own rows and older
    ones, never those of a later batch, so replaying changes nothing."""

    BATCH = "fb_batch"

    def __init__(self, path: str, keys: Sequence[str], order_by: str | None = None, time_key: str | None = None, unit: str = "day", buckets: int = 16):
        self.keys = list(keys)
        self.order_by = order_by
        self.table = PartitionedTable(path, time_key or self.keys, unit if time_key else None, buckets)

    def read(self, spark: SparkSession) -> DataFrame | None:
        rows = self.table.read(spark)
        return None if rows is None else rows.drop(self.BATCH)

    def _last_per_key(self, batch: DataFrame) -> DataFrame:
        """Last row per key by ``order_by`` (ties: the larger remaining
        columns), as a map-side aggregate: a hot key is reduced in every
        task before the shuffle."""
        if self.order_by is None:
            return batch.dropDuplicates(self.keys)
        rest = [c for c in batch.columns if c not in self.keys and c != self.order_by]
        best = batch.groupBy(*self.keys).agg(F.max(F.struct(self.order_by, *rest)).alias("_last"))
        return best.select(*self.keys, *[F.col(f"_last.{c}").alias(c) for c in [self.order_by, *rest]]).select(
            *batch.columns
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        part = self.table.PART
        # One evaluation of the batch; everything below reads the saved rows.
        new = materialize(self._last_per_key(batch).withColumn(self.BATCH, F.lit(batch_id).cast("long")).withColumn(part, self.table.part()))
        span = new.agg(F.count(F.lit(1)), F.min(part), F.max(part)).first()
        if not span[0]:  # e.g. a watermark-only micro-batch
            return
        current = self.table.parts(batch.sparkSession)
        if current is not None:
            touched = current.where(F.col(part).between(F.lit(span[1]), F.lit(span[2])) | F.col(part).isNull())
            touched = semi_join(touched, new.select(part).distinct(), [part]).select(*new.columns)
            new = anti_join(new, touched.where(F.col(self.BATCH) > batch_id), self.keys)
            new = materialize(new.unionByName(anti_join(touched, new, self.keys)))
        self.table.overwrite(new.drop(part))


def jdbc_append(url: str, table: str, properties: dict | None = None, batchsize: int = 100_000):
    """``foreachBatch`` function appending each micro-batch to a table."""

    def write(batch: DataFrame, _batch_id: int) -> None:
        (
            batch.write.format("jdbc")
            .option("url", url)
            .option("dbtable", table)
            .option("batchsize", batchsize)
            .options(**(properties or {}))
            .mode("append")
            .save()
        )

    return write


def start_foreach_batch(df: DataFrame, fn, checkpoint: str, mode: str = "update",
                        available_now: bool = True) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
