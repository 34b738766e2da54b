"""Events as a stream of files: duplicates dropped, counts by event time, sessions, and sinks that can be run again.

A stream's state is bounded by its watermark: rows that come later than ``late`` behind the latest event are dropped, and
so is what is remembered of older ones. Progress is kept in a checkpoint folder; a run that is broken off or repeated goes on
from there, and each batch replaces what an earlier try of the same batch has written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from basketry.operators.joins import latest

BATCH = "batch_id"


def land(rows: DataFrame, folder: str, slices: Sequence[Column]) -> None:
    """Adds rows to a landing folder slice by slice (each a condition), so that a stream of files meets them in that order. A row in several slices lands several times."""
    for here in slices:
        rows.where(here).write.mode("append").parquet(folder)


def file_stream(spark: SparkSession, folder: str, schema: StructType | str, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream, oldest first."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def timed(events: DataFrame, late: str | None, at: str = "ts") -> DataFrame:
    """A stream with its watermark; None where it stands already (a stream has one)."""
    return events.withWatermark(at, late) if events.isStreaming and late else events


def unique_events(events: DataFrame, keys: Sequence[str], late: str | None = "7 days", at: str = "ts") -> DataFrame:
    """Each event once, by its keys. A stream remembers keys until the watermark passes them and forgets repeats that come later than that with the rest that is late."""
    return timed(events, late, at).dropDuplicatesWithinWatermark(list(keys)) if events.isStreaming else events.dropDuplicates(list(keys))


def daily_counts(events: DataFrame, late: str | None = "7 days", width: str = "1 day") -> DataFrame:
    """Events and the sum of their values by day and type."""
    return timed(events, late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = "1 day") -> DataFrame:
    """A user's events without a longer gap, as one row."""
    return timed(events, late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def _replace(batch: DataFrame, number: int, path: str) -> None:
    batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={number}")


def upsert_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what changes in each batch under its number, and stops when the input is used up. ``current`` reads the state of all keys; no window has to wait until it is final."""
    return rows.writeStream.outputMode("update").foreachBatch(partial(_replace, path=path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The last version of each key that ``upsert_to`` has written."""
    written = spark.read.schema(StructType([*schema.fields]).add(BATCH, "long")).option("basePath", path).parquet(path)
    return latest(written, keys, [F.desc(BATCH)]).drop(BATCH)


def append_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what is final as Parquet, exactly once, and stops when the input is used up."""
    return rows.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def finished(query: StreamingQuery) -> int:
    """Waits for the end of a stream; the rows that came too late in this run."""
    query.awaitTermination()
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
