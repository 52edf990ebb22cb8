"""Document feed as a file stream: each drop becomes RAW rows exactly once.

The same projection as the batch feed, driven by Structured Streaming. The checkpoint
remembers which files were taken; a micro-batch that runs again replaces its own
partition, so a restart neither loses nor doubles documents.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from goldrow.session import shared_folder
from goldrow.sinks.writers import replace_batches
from goldrow.sources.feeds import feed_to_raw

# Columns of a landed feed record.
FEED_SCHEMA = "entity_id string, entity_type string, country_code string, response_json string"


def stream_feed(
    spark: SparkSession, folder: str, target: str, entity_type: str, run_time: datetime, name: str
) -> StreamingQuery:
    """Take all feed files that are there and not yet taken, then stop.

    ``name`` identifies the stream: its checkpoint lies in the shared folder.
    """
    feed = spark.readStream.schema(FEED_SCHEMA).json(folder)
    rows = feed_to_raw(feed, entity_type, run_time)

    def load(batch: DataFrame, number: int) -> None:
        replace_batches(batch.withColumn("drop_number", F.lit(number)), target, ("drop_number",))

    return (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{shared_folder(spark)}/goldrow/streams/{name}")
        .trigger(availableNow=True)
        .start()
    )
