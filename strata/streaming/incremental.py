"""Incremental bronze -> silver with Structured Streaming.

The batch flow re-reads the wanted partitions of each run. Driven as a stream instead,
Spark's file source remembers which bronze files it has processed (in the checkpoint
location), so every trigger hands only newly landed files to the same silver logic:
clean + dedup the micro-batch (O11-O21) and apply the guarded merges (O22, O23) to the
versioned tables. ``availableNow`` processes what is there and stops, like a scheduled
run; a continuous trigger keeps the tables current as files arrive.

Effectively once for each table: the identity of the checkpoint and the micro-batch id are
part of the commit that the batch produced, so a batch replayed after a failure is skipped by
the table that holds it and applied by the one that does not. A new checkpoint location is
a new stream: it reads all files again, and the merges are idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.operators import merge, silver
from strata.session import materialize
from strata.sources.tables import VersionedTable, batch_time


def silver_micro_batch(
    listings: VersionedTable,
    neighbourhoods: VersionedTable,
    *,
    stream: str,
    tiebreak=None,
):
    """The ``foreachBatch`` function: one micro-batch of bronze rows into both tables.

    ``stream`` identifies the query's checkpoint: batch ids count from 0 in each checkpoint
    location, so an id means something only together with it."""

    def run(batch: DataFrame, batch_id: int) -> None:
        frames = silver.transform_to_silver(batch, tiebreak=tiebreak)
        rows = materialize(frames.listings)
        hoods = materialize(frames.neighbourhoods)
        listings.create()
        neighbourhoods.create()
        done = (stream, int(batch_id))
        batch_ts = batch_time()
        listings.merge(rows, lambda old, new: merge.upsert_hash_guarded(old, new, batch_ts=batch_ts, mark=True), stream=done, effect=merge.guarded_effect)
        neighbourhoods.merge(
            hoods, lambda old, new: merge.upsert_overwrite(old, new, batch_ts=batch_ts, mark=True),
            gate_rows=hoods.withColumn("loaded_at", F.lit(batch_ts).cast("timestamp")), stream=done,
        )

    return run


def start_bronze_to_silver(
    spark: SparkSession,
    *,
    bronze_root: str,
    schema: T.StructType,
    listings: VersionedTable,
    neighbourhoods: VersionedTable,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    tiebreak=None,
) -> StreamingQuery:
    """Start the stream over the bronze folder (partition folders are discovered)."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    source = reader.parquet(bronze_root)
    writer = (
        source.writeStream.foreachBatch(silver_micro_batch(listings, neighbourhoods, stream=checkpoint_location, tiebreak=tiebreak))
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
