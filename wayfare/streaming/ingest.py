"""Upserts driven by a file stream.

The stream's own checkpoint knows which files were read, in place of comparing
row counts. Each micro-batch is merged into the stored table by ``plans.update``. A
batch that is run again, after a failure between its write and its note in the
checkpoint, changes nothing: merging rows with a key twice is the same as once, and
rows without one carry the query and batch that brought them, so those of an
earlier try are left out. A new checkpoint has another query id, hence loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.changes import has_keys
from ..plans.update import update
from ..session import path_exists

#: Which query and batch inserted or updated a row.
BATCH = "_batch"


def merge_batch(
    root: str, keys: Sequence[str], order: Sequence[str], parts: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    if not set(parts) <= set(keys):
        raise ValueError("parts must be columns of the key")

    def apply(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or root
        marked = batch.withColumn(BATCH, F.lit(f"{query}:{batch_id}"))
        tried = ~has_keys(keys) & F.col(BATCH).eqNullSafe(F.lit(f"{query}:{batch_id}"))
        update(root, marked, keys, order, parts, drop=tried)

    return apply


def current(files: DataFrame, root: str) -> DataFrame:
    """The table without the batch marks; empty if nothing has come yet."""
    spark = files.sparkSession
    if not path_exists(spark, root):
        return spark.createDataFrame([], files.schema)
    return spark.read.schema(files.schema).parquet(root).select(*files.columns)


def ingest(
    files: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], parts: Sequence[str] = ()
) -> DataFrame:
    """Merge everything that is new in a ``readStream`` source, then stop.

    ``parts`` are columns of the key (say year and month) that divide the table:
    a batch then reads and writes only the parts that its rows are in.
    """
    query = (
        files.writeStream.foreachBatch(merge_batch(root, keys, order, parts))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return current(files, root)
