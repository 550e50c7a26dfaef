"""Reading new model files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.sources.reader import read


def watch(spark: SparkSession, root: str, checkpoint: str, apply: Callable[[DataFrame, DataFrame, int], None], once: bool = True) -> StreamingQuery:
    """Parse files that appear below root; ``apply(elements, relations, batch)`` gets each batch.

    A batch that is run again after a failure has the same number, so that ``apply`` can write
    idempotently.
    """
    files = spark.readStream.format("text").schema("value string").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.sysml").load(root)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))

    def each(batch: DataFrame, number: int) -> None:
        apply(*read(batch), number)

    writer = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
