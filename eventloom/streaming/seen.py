"""Incremental runs: keys met for the first time, as a stream with state by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_seen(stream: DataFrame, key: str, order: str) -> DataFrame:
    """For each batch the first row by order of each key that no earlier batch had; null and empty keys are left out.

    The state store holds a key's first row and the time of its batch; a batch reads and writes the keys that it
    has, however many there are. Rows are new if the time is the batch's own, which Spark logs with its offsets and
    uses again if the batch is repeated. State never expires, as in a run without a watermark. For update mode.
    """
    rest = [c for c in stream.columns if c not in (key, order)]
    now = F.current_timestamp()
    kept = stream.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").withColumn("seen_at_", now)
    first = kept.groupBy(key).agg(F.min(F.struct("seen_at_", order, *rest)).alias("m_"))
    return first.filter(F.col("m_.seen_at_") == now).select(*[F.col(c) if c == key else F.col(f"m_.{c}") for c in stream.columns])


def collect_unseen(stream: DataFrame, key: str, order: str, table: str, checkpoint: str) -> None:
    """Append to a Parquet table the first row of each key that it does not hold, batch by batch, to the stream's end.

    A batch goes to a folder of its own number, which is replaced if the batch is run again, so a restart repeats no
    row. The table itself is not read. State is kept in RocksDB unless the session names a provider, so that it need
    not fit in memory; a later run must use the same checkpoint folder and provider.
    """
    spark = stream.sparkSession
    own = spark.conf.get(PROVIDER, None)
    if own is None or own.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKSDB)

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_={number}")

    try:
        first_seen(stream, key, order).writeStream.outputMode("update").foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        if own is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, own)
