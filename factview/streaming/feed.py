"""Publishing a table from a stream of files.

A version of the table is a list of folders. Each micro-batch is written to a
folder of its own, which the next version has after those before, so that
readers see whole batches only and nothing is written twice. A batch that is
replayed after a failure is recognised by its number and skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from factview.store.publishing import publish
from factview.store.snapshot import Store
from factview.store.staging import stage_append


def publish_stream(store: Store, table: str, folder: str, schema: StructType | str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Publishes all files of a folder, as far as they are there, and stops."""

    def each(batch: DataFrame, number: int) -> None:
        live = store.published("table", table)
        if live and live.get("batch", -1) >= number:
            return
        publish(store, [stage_append(store, table, batch, number)])

    files = store.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
