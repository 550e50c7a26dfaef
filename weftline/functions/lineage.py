"""Where lineage is cut: checkpoints in the folder that the session names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """Compute and checkpoint in ``spark.checkpoint.dir``.

    Where that is unset and all runs in one process, in a folder of this machine; on a cluster it must be set.
    """
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(found or tempfile.mkdtemp(prefix="weftline-"))
    return df.checkpoint()
