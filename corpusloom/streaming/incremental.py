"""Repeated synchronisation as Structured Streaming: bounded file batches, keyed counters, deduplication, windows."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from corpusloom.session import shared_dir


def stream_of(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """A folder of parquet files as a stream; its schema is that of the files there."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_available(stream: DataFrame, path: str | None = None, mode: str = "append", each=None) -> str:
    """Runs a stream over all that is available and stops; the folder of its results. Restarting goes on from its checkpoint.

    each: (batch DataFrame, batch id) -> None takes the place of the parquet sink.
    """
    at = path or f"{shared_dir(stream.sparkSession)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/_state").trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").option("path", f"{at}/data").start()
    query.awaitTermination()
    return f"{at}/data"


def windowed_counts(events: DataFrame, at: str, kind: str, length: str, late: str) -> DataFrame:
    """Counts and sums by window and kind; events later than `late` don't count."""
    return events.withWatermark(at, late).groupBy(F.window(at, length).alias("w"), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), kind, "n", "total")


def first_seen(events: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """The first event of each key within the watermark; state for older keys is dropped."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, at: str, key: str, gap: str, late: str) -> DataFrame:
    """Runs of events of a key with no pause of `gap`."""
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("began"), F.col("w.end").alias("ended"), "n")


def status_changes(log: DataFrame) -> DataFrame:
    """(crawler_type, status, delta) of a stream of states (seq, doc_id, crawler_type, status): +1 where a document comes to a status, -1 where it leaves one.

    The latest state of each document is kept in the stream's state store, so a batch costs its own rows; states that arrive late
    (a lower seq than the one kept) and repeated ones change nothing.
    """

    def run(key, frames, state):
        seq, status = state.get if state.exists else (None, None)
        was = status
        for frame in frames:
            for s, x in zip(frame["seq"], frame["status"], strict=True):
                if seq is None or s > seq:
                    seq, status = int(s), x
        if seq is not None:
            state.update((seq, status))
        if status != was or not was:
            rows = [(key[1], x, d) for x, d in ((was, -1), (status, 1)) if x is not None]
            yield pd.DataFrame(rows, columns=["crawler_type", "status", "delta"])

    rows = log.where("doc_id is not null and seq is not null").select("doc_id", "crawler_type", "seq", "status")
    return rows.groupBy("doc_id", "crawler_type").applyInPandasWithState(run, "crawler_type string, status string, delta int", "seq long, status string", "update", GroupStateTimeout.NoTimeout)


def sync_each(target: str, key: str = "key"):
    """A foreachBatch function that compares a batch of items (key, fingerprint, order) with what is held, writes the actions, and takes the items in.

    A batch's actions and what it adds are written under its number, so a batch that runs again writes the same; what is held is the last
    of each key over all additions before.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        items = batch.groupBy(key).agg(F.max_by("fingerprint", "order").alias("fingerprint"))
        none = spark.createDataFrame([], f"{key} string, fingerprint string, number int")
        # only versions of earlier batches count, whatever a failed run left behind
        held = spark.read.parquet(*[f"{target}/added-{i}" for i in range(number)]) if number else none
        held = held.groupBy(key).agg(F.max_by("fingerprint", "number").alias("held"))
        action = F.when(F.col("held").isNull(), "new").when(F.col("held") == F.col("fingerprint"), "unchanged").otherwise("changed")
        judged = items.join(held, key, "left").select(key, "fingerprint", action.alias("action"), F.lit(number).alias("number"))
        judged.write.mode("overwrite").parquet(f"{target}/actions-{number}")
        done = spark.read.parquet(f"{target}/actions-{number}").where("action <> 'unchanged'")
        done.select(key, "fingerprint", "number").write.mode("overwrite").parquet(f"{target}/added-{number}")

    return take
