"""Fill frames as requests for them arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridscale.operators.materialise import fill_pending
from gridscale.operators.store import GridStore

REQUESTS = "frame INT"


def frame_requests(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of requested frames from Parquet files dropped into a folder."""
    reader = spark.readStream.schema(REQUESTS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def fill_from_stream(requests: DataFrame, store: GridStore, run_id: str, views: DataFrame,
                     checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Materialise the views whose frames are requested and not yet in the run.

    Each micro-batch is one commit named after it. A batch that is replayed after a crash
    finds its frames in the log and commits nothing, so a frame is computed once however
    often it is asked for; a request for a frame without a view is ignored.
    """
    def fill(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        here = GridStore(spark, store.root)
        wanted = views.join(batch.select("frame").distinct(), "frame", "left_semi")
        fill_pending(here, run_id, wanted, message=f"stream batch {batch_id}")

    writer = requests.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fill)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
