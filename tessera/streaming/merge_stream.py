"""The merge over a stream of chunk extractions.

Claims are derived row by row and appended to a table by micro-batch; since the merge takes its
order from (chunk, place) and never from arrival, merging that table at any time equals one batch
merge of what has arrived. Batches are written under their number, so a replayed one replaces
itself. A chunk that arrives again replaces what it said before: the latest batch counts. Running
counts per document come from a stateful aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

CHUNKS = "doc string, ci int, cid string, ok boolean, extraction string, confidence double"


def read_chunks(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(CHUNKS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def store_chunks(chunks: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append arriving chunks under batch=<number>; a retry of a batch overwrites only its own folder."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return chunks.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_arrived(spark: SparkSession, folder: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The merge of all that has arrived.

    Of a chunk (doc, cid) that came several times the row of the latest batch counts; within a batch, the one
    whose (ok, extraction, confidence, ci) is largest, so the result does not depend on the order of rows.
    """
    rows = spark.read.schema(CHUNKS + ", batch int").parquet(folder)
    said = F.struct("ok", "extraction", "confidence", "ci")
    last = rows.groupBy("doc", "cid").agg(F.max(F.struct("batch", said.alias("said"))).alias("last"))
    return merge(last.select("doc", "last.said.ci", "cid", "last.said.ok", "last.said.extraction", "last.said.confidence"))


def running_stats(chunks: DataFrame, time: str | None = None, delay: str = "1 day") -> DataFrame:
    """doc, chunks_merged, chunks_failed, confidence_min, confidence_avg, updated as chunks arrive.

    A chunk that comes again is not counted again; the first arrival counts. With a time column, chunk ids are
    remembered for ``delay`` behind the latest time and then forgotten; without one they are kept for good.
    """
    if time:
        once = chunks.withWatermark(time, delay).dropDuplicatesWithinWatermark(["doc", "cid"])
    else:
        once = chunks.dropDuplicates(["doc", "cid"])
    c = F.when(F.col("ok"), F.col("confidence"))
    return once.groupBy("doc").agg(F.count_if("ok").alias("chunks_merged"), F.count_if(~F.col("ok")).alias("chunks_failed"), F.min(c).alias("confidence_min"), F.avg(c).alias("confidence_avg"))
