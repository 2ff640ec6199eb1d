"""Structured Streaming twins: messages exactly once, and events merged batch by batch. The batch operators decide; the
streams only feed them, so that a restart from the checkpoint gives the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cadenza.operators import delivery
from cadenza.sources.store import Store

_SEEN = "producer string, lo bigint, hi bigint, n bigint"


def exactly_once_stream(stream: DataFrame, identifier: str, received: str, row: str, store: Store, out: str, checkpoint: str) -> StreamingQuery:
    """Appends to ``out`` the first delivery of each message; what was seen before is kept as ranges in ``store``, and
    malformed identifiers as a keyed table. A batch that is run again reads the state from before it: that of the last
    batch with a smaller number, so ``store``, ``out`` and ``checkpoint`` belong together."""

    def batch(df: DataFrame, number: int) -> None:
        seen = store.read("seen", _SEEN, before=number)
        odd = store.read("odd", "id string", before=number)
        producer, _ = delivery.split_identifier(F.col(identifier))
        fresh = delivery.not_seen(df, identifier, seen).join(odd.withColumnRenamed("id", identifier), identifier, "left_anti").persist()
        try:
            once = delivery.exactly_once(fresh, identifier, received, row)
            once.select(*df.columns).write.mode("overwrite").parquet(f"{out}/batch={number:012d}")
            new = delivery.seen_ranges(fresh, identifier, received, row)
            store.write("odd", odd.unionByName(fresh.where(producer.startswith("=")).select(F.col(identifier).alias("id"))).distinct(), number)
            store.write("seen", delivery.merge_seen(seen, new), number)
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by key and window of event time; rows later than the watermark are left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


def sessions(stream: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n")
