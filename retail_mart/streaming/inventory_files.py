"""Event-driven inventory loads with Structured Streaming.

The reference loads an inventory file when it arrives (truncate, then copy
with bad rows skipped). Here a file-source stream watches the landing folder;
each new file is one micro-batch (``maxFilesPerTrigger=1``) that becomes the
next version of the raw inventory table, with its rejected lines as the
same version of ``inventory_rejects``; one marker makes both current. The
stream's checkpoint (in the shared folder) records which files were loaded,
and a version is claimed for the stream's id and batch number: a batch that
is repeated after a crash writes the same version again, or nothing if it was
complete, so each file is loaded exactly once. ``availableNow`` processes
what has landed and stops -- schedule it like the reference's trigger, or run
it continuously with a processing-time trigger.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from retail_mart.sources import files, ingest, sinks


def load_landed_inventory(spark: SparkSession, landing_dir: str, raw_root: str, checkpoint_dir: str,
                          continuous: bool = False):
    """Start (and, unless ``continuous``, finish) the inventory file stream."""
    stream = (spark.readStream.schema(ingest.inventory_read_schema()).options(**ingest.CSV_OPTIONS)
              .option("maxFilesPerTrigger", 1).csv(landing_dir))
    inv_root = f"{raw_root.rstrip('/')}/inventory"
    rej_root = f"{raw_root.rstrip('/')}/inventory_rejects"

    def load(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()           # parsed once, split twice
        try:
            good, rejects = ingest.split_inventory(batch)
            # the id lives in the checkpoint: another checkpoint is another stream
            stream_id = json.loads(files.read_text(spark, f"{checkpoint_dir.rstrip('/')}/metadata"))["id"]
            sinks.write_together([(rejects, rej_root), (good, inv_root)], sinks.KEEP_VERSIONS, f"{stream_id}/{batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(processingTime="1 minute") if continuous else writer.trigger(availableNow=True)
    query = writer.start()
    if not continuous:
        query.awaitTermination()
    return query
