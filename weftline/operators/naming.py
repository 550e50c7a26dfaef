"""Names that are unique within a model, as short as they can be."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEPTH = 7


def disambiguate(elements: DataFrame, model: str = "model", name: str = "name", qualified: str = "qualified", depth: int = DEPTH) -> DataFrame:
    """Adds ``display``: the bare name if one element has it, else the least owner suffix that is unique.

    Each depth only compares what is still contested, so it goes depth by depth: the rank of a
    suffix among the remaining rows decides which leave. Those that share the whole qualified
    name share it as their display.
    """
    segments = F.split(F.upper(qualified), "::")
    rows = elements.withColumn("_segments", segments).withColumn("_bare", F.upper(name)).withColumn("display", F.lit(None).cast("string"))
    alone = F.count(F.lit(1)).over(Window.partitionBy(model, "_bare")) == 1
    rows = rows.withColumn("display", F.when(alone, F.col("_bare")))
    most = elements.select(F.max(F.size(segments))).first()[0] or 1  # deeper suffixes are no longer than a name
    for d in range(1, min(depth, most) + 1):
        taken = F.greatest(F.size("_segments") - d, F.lit(1))
        rows = rows.withColumn("_suffix", F.array_join(F.slice("_segments", taken, F.lit(d + 1)), "_"))
        left = F.col("display").isNull()
        group = Window.partitionBy(model, "_bare", F.when(left, F.col("_suffix")))
        single = F.sum(left.cast("int")).over(group) == 1
        rows = rows.withColumn("display", F.when(left & single, F.col("_suffix")).otherwise(F.col("display")))
    return rows.withColumn("display", F.coalesce("display", F.upper(qualified))).drop("_segments", "_bare", "_suffix")
