"""Streams: incremental ingestion with exactly-once commits, and leaky buckets as keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scriptoria.operators.incremental import CommitStore, Lost

LEVEL_SCHEMA = "key string, time_us bigint, amount bigint, level bigint"


def ingest_stream(stream: DataFrame, root: str, checkpoint: str, step: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Each micro-batch becomes one commit; a batch that is replayed after a failure commits nothing twice."""

    def once(batch: DataFrame, number: int) -> None:
        from scriptoria.operators.incremental import Bounds

        store = CommitStore(batch.sparkSession, root)
        done = store.last()
        if done and done["watermark"] is not None and number <= done["watermark"]:
            return
        bounds = Bounds(done["number"] + 1 if done else 1, done["watermark"] if done else None, number)
        try:
            store.commit(bounds, step(batch))
        except Lost:
            if store.last()["watermark"] < number:
                raise

    return stream.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def committed(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All committed outputs of a store."""
    import json

    log = spark.read.text(f"{root}/log/*.json", wholetext=True).collect()  # one short line per committed run
    return spark.read.schema(schema).parquet(*[json.loads(r["value"])["output"] for r in log])


def leaky_stream(charges: DataFrame, limit: int, window_s: int) -> DataFrame:
    """charges(key, time_us, amount) -> rows with the level in millionths, state kept per key."""

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        level, last = state.get if state.exists else (0, None)
        out = []
        for b in batches:
            for t, a in b.sort_values(["time_us"], kind="stable")[["time_us", "amount"]].itertuples(index=False):
                if last is not None:
                    level = max(0, level - (int(t) - last) * limit // window_s)
                level, last = level + int(a) * 1_000_000, int(t)
                out.append((key[0], int(t), int(a), level))
        state.update((level, last))
        yield pd.DataFrame(out, columns=["key", "time_us", "amount", "level"])

    return charges.groupBy("key").applyInPandasWithState(fold, LEVEL_SCHEMA, "level bigint, last bigint", "append", "NoTimeout")


def windowed_counts(stream: DataFrame, time_col: str, by: str, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Counts per window and value; rows later than the watermark are dropped by definition of the window."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, size), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), by, "n")
