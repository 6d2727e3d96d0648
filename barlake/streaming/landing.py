"""Landed files as a stream into a stored table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from barlake.sources.landing import normalise, read_landed
from barlake.sources.store import Store


def start_upsert_stream(
    store: Store,
    table: str,
    landing: str,
    checkpoint: str,
    fmt: str = "parquet",
    read: Callable[[list[str]], DataFrame] | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 1000,
    **options: str,
) -> StreamingQuery:
    """Upsert every file that is in ``landing`` and not yet taken, then stop.

    The stream is one of files; each micro-batch reads its files as the batch reader does: CSV by
    header name, JSON as text cells, Parquet by the table's types, unless ``read`` replaces that. The
    upsert is idempotent, so a micro-batch that is repeated after a failure leaves the same table,
    and any lateness is accepted: a revision simply replaces its row.
    """
    spark = store.spark
    listing = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(listing).options(**options)
    files = files.option("maxFilesPerTrigger", files_per_batch)
    shaped = shape or (lambda df: normalise(df, table))
    reader = read or (lambda paths: read_landed(spark, paths, fmt, table))

    def take(batch: DataFrame, _id: int) -> None:
        # The names of the batch's files, of which there are files_per_batch at most; their content
        # is not read here.
        paths = sorted(r["path"] for r in batch.select("path").collect())
        if paths:
            # Text is parsed once and staged; Parquet is read again column by column.
            store.upsert(shaped(reader(paths)), table, staged=fmt != "parquet")

    return (
        files.load(landing).select("path")
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_upsert(store: Store, table: str, landing: str, checkpoint: str, **kwargs) -> DataFrame:
    """Run :func:`start_upsert_stream` to its end and return the stored table."""
    start_upsert_stream(store, table, landing, checkpoint, **kwargs).awaitTermination()
    return store.scan(table)
