"""Pick up new files as a stream and load each batch like any other load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions import mime
from quire.plans.load import LoadOptions, load_files
from quire.plans.store import PageStore

LISTING = "path string, modificationTime timestamp, length long, content binary"


def stream_files(spark: SparkSession, source_dir: str, suffix: str = "pdf") -> DataFrame:
    """A stream of file rows of a directory; ordinals are given per batch."""
    either_case = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    rows = (
        spark.readStream.format("binaryFile").schema(LISTING)
        .option("pathGlobFilter", f"*.{either_case}").load(source_dir)
    )
    return rows.select(
        F.col("path").alias("file_path"),
        mime.file_name(F.col("path")).alias("file_name"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("file_modified_at"),
    )


def ingest(
    store: PageStore,
    stream: DataFrame,
    checkpoint: str,
    options: LoadOptions = LoadOptions(),
    trigger: dict | None = None,
    index: dict | None = None,
) -> StreamingQuery:
    """Load every batch of a stream of file rows, and with ``index`` (settings of ``update_index``) make it searchable.

    What is known is decided by the store and by its index, not by stream state: a batch that is
    replayed after a failure skips what is committed, and a load that was not indexed any more
    gets its segment from the replay. So a replayed batch adds nothing twice.
    """

    def load_batch(batch: DataFrame, _batch_id: int) -> None:
        if "ordinal" not in batch.columns:
            if "content" in batch.columns:
                raise ValueError("file rows that carry their content need an ordinal column")
            ordered = batch.repartitionByRange("file_path").sortWithinPartitions("file_path")
            batch = ordered.withColumn("ordinal", F.monotonically_increasing_id())
        load_files(store, batch, options)
        if index is not None:
            store.update_index(**index)

    return (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
