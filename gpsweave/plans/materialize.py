"""Cutting lineage for a small result that a plan reads more than once
(per-chunk count tables, the served vehicle state).

``materialize`` writes it once with ``checkpoint()`` into the shared folder
named by ``spark.checkpoint.dir`` (set only when absent, e.g. in local tests);
the readers use the written copy, and recovery after a lost executor reads it
instead of recomputing the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
