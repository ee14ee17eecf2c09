"""Event ingestion: parse, check, reshape, route."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from costalloc.sources import files
from costalloc.sources.events import (
    DIMENSIONS,
    ERROR_EVENT,
    drop_empty_dims,
    envelope_numbers,
    parse_events,
    split_events,
)
from costalloc.streaming.segments import Segments


def body_stream(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """Event bodies as text from any streaming source with a `value` column
    (a message log such as Kafka, or text files)."""
    stream = spark.readStream.format(source).options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def stream_ingest(bodies: DataFrame) -> DataFrame:
    """Valid events with typed numbers; bad bodies are skipped."""
    return envelope_numbers(parse_events(bodies))


def start_ingest(bodies: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append valid events to Parquet. The file sink and its log make this exactly-once."""
    writer = stream_ingest(bodies).writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def route_batch(batch: DataFrame) -> DataFrame:
    """Every body of a batch once, as forwarded record, with its route: call, error or reject."""
    events, rejects = split_events(batch)
    event_type = F.col("customDimensions")[DIMENSIONS[0][0]]
    forwarded = drop_empty_dims(events).select(
        F.when(event_type == ERROR_EVENT, "error").otherwise("call").alias("Route"),
        F.to_json(F.struct("message", "customDimensions")).alias("Record"),
    )
    return forwarded.unionByName(rejects.select(F.lit("reject").alias("Route"), F.col("body").alias("Record")))


ROUTED = T.StructType([T.StructField("Record", T.StringType()), T.StructField("Route", T.StringType())])


def routed_store(spark: SparkSession, path: str) -> Segments:
    return Segments(spark, path, ROUTED, lambda rows: rows, partition="Route")


def start_route_errors(bodies: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write calls, errors and rejects of every batch to folders of their own, and note how many there were.

    One partitioned write per batch, which is counted on the way; a batch that is run again replaces what it wrote
    before. Batches are merged in levels, so that files stay few.
    """
    spark = bodies.sparkSession
    kept = routed_store(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        seen, failed = Observation(), F.col("Route") == "reject"
        counted = route_batch(batch).observe(
            seen, F.count("*").alias("batch_size"), F.count_if(~failed).alias("processed_count"), F.count_if(failed).alias("error_count")
        )
        if kept.write(counted, batch_id):
            note = f"{path}/notes/{batch_id:012d}.json"
            files.delete(spark, note)
            files.put_text(spark, note, json.dumps({"Batch": batch_id, **seen.get}))
        kept.keep_small()

    writer = bodies.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    return routed_store(spark, path).read()


def batch_counts(spark: SparkSession, path: str) -> DataFrame:
    """Size, processed and failed events of every batch, as counted when it was written."""
    return spark.read.schema("Batch bigint, batch_size bigint, processed_count bigint, error_count bigint").json(f"{path}/notes")
