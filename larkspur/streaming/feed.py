"""The change log as a stream: notifications, and two extensions, duplicates within a watermark and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def payload():
    return F.to_json(F.struct("type", "id", "property_id"))


def notifications(changes: DataFrame) -> DataFrame:
    """JSON payloads of an append-only change log (type, id, property_id)."""
    return changes.select(payload().alias("payload"))


def open_log(spark: SparkSession, folder: str, schema, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def first_events(events: DataFrame, keys: list[str], at: str = "ts", late: str | None = None) -> DataFrame:
    """One event for each of ``keys``, however the events are spread over files and batches: each key stays in the state.

    With ``late`` keys are forgotten again once the watermark is that far behind their event, so that the state is bounded and a key
    that comes back after that time is a first event again; when exactly depends on the batches.
    """
    return events.dropDuplicates(keys) if late is None else events.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def sessions(events: DataFrame, key: str, at: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def drain(stream: DataFrame, sink, checkpoint: str) -> None:
    """Runs a stream over what is there and hands each batch to ``sink(batch, number)``."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def landed(stream: DataFrame, folder: str) -> DataFrame:
    """Runs an append-only stream over what is there into a folder that all machines share, and reads what it wrote."""
    query = stream.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")
