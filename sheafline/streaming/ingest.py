"""Incremental runs: each new file of pages is read once, processed as a whole, and appended to the output.

A document's pages come in one file, as repeated lines need all of them. The stream's checkpoint remembers the files, and
each batch is written under its number, so a batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.documents import local_documents
from ..sources.engines import Config

PAGES = "doc_id string, page_no int, text string, ocr_text string"


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, config: Config = Config(), files_per_batch: int = 100) -> None:
    """Process what is new in ``source`` (Parquet files of pages) and stop."""

    def each(batch: DataFrame, number: int) -> None:
        local_documents(batch, config).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
